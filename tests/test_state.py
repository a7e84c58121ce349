"""Stored state: upserts, replays, conditional updates, countries; and the library without its llm part."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postloom.functions.countries import structured_country
from postloom.operators import state
from postloom.operators.state import batch_writer, conditional_update, current, upsert

ROOT = Path(__file__).resolve().parent.parent


def test_upsert_and_replay(spark, tmp_path):
    folder = str(tmp_path / "state")
    assert current(spark, folder) is None
    make = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    assert upsert(spark, folder, make((1, "a"), (2, "b")), ["k"], "r-0")
    assert upsert(spark, folder, make((2, "c"), (3, "d")), ["k"], "r-1")
    assert not upsert(spark, folder, make((2, "old")), ["k"], "r-1")
    batch_writer(folder, ["k"], "r")(make((4, "e"), (4, "e")), 7)
    batch_writer(folder, ["k"], "r")(make((4, "again")), 7)
    assert sorted(map(tuple, current(spark, folder).collect())) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    assert upsert(spark, folder, make(), ["k"]) and current(spark, folder).count() == 4


def test_a_writer_that_dies_loses_nothing(spark, tmp_path, monkeypatch):
    """Before and after every step of a write the state is the old one or the new one, and the next write goes on from there."""
    folder = str(tmp_path / "state")
    make = lambda *rows: spark.createDataFrame(list(rows), "k int, v string")
    read = lambda: sorted(map(tuple, current(spark, folder).collect()))
    assert upsert(spark, folder, make((1, "a"), (2, "b")), ["k"], "r-0", parts=4)

    def dies(*args, **named):
        raise InterruptedError

    for step in ("_put", "quote", "_read"):
        with monkeypatch.context() as patch:
            patch.setattr(state, step, dies)
            with pytest.raises(InterruptedError):
                upsert(spark, folder, make((2, "lost"), (9, "lost")), ["k"], "r-1")
        assert read() == [(1, "a"), (2, "b")]
    (tmp_path / "state" / "log" / ".draft-left-over").write_text("{")
    assert upsert(spark, folder, make((2, "c"), (9, "z")), ["k"], "r-1") and read() == [(1, "a"), (2, "c"), (9, "z")]
    assert not upsert(spark, folder, make((2, "old")), ["k"], "r-0")
    with pytest.raises(OSError):
        state._put(spark, folder, 2, "other", {})
    wider = spark.createDataFrame([(5, "e", 7), (1, None, 8)], "k int, v string, w int")
    assert upsert(spark, folder, wider, ["k"]) and sorted(current(spark, folder).collect()) == sorted([(1, None, 8), (2, "c", None), (5, "e", 7), (9, "z", None)], key=lambda r: r[0])


def test_untouched_parts_stay(spark, tmp_path):
    folder = str(tmp_path / "state")
    upsert(spark, folder, spark.range(200).withColumn("v", F.lit(1)), ["id"], "a", parts=16)
    upsert(spark, folder, spark.range(1).withColumn("v", F.lit(2)), ["id"], "b")
    assert len(list((tmp_path / "state" / "data" / "gen=2").glob("_part=*"))) == 1
    assert current(spark, folder).count() == 200 and current(spark, folder).where("v = 2").count() == 1
    writer = batch_writer(folder, ["id"], "r", order="v")
    writer(spark.createDataFrame([(0, 5), (0, 9), (0, None)], "id bigint, v int"), 1)
    assert current(spark, folder).where("id = 0").first().v == 9


def test_conditional_update(spark):
    stored = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, s string")
    new = spark.createDataFrame([(1, "unknown"), (2, "z"), (3, "w")], "k int, s string")
    assert sorted(map(tuple, conditional_update(stored, new, ["k"], ["s"], unless="unknown").collect())) == [(1, "x"), (2, "z"), (3, "w")]


def test_structured_country(spark):
    rows = [("UK", "GB"), (" usa ", "US"), ("CA", "CA"), ("Germany", "DE"), ("EU", None), ("アメリカ合衆国", "US"), ("Nowhere", None), ("", None), (None, None)]
    frame = spark.createDataFrame([(v, "x", "y") for v, _ in rows], "v string, written string, country_code string")
    got = structured_country(frame, "v")
    assert got.columns == ["v", "written", "country_code"] and {r.v: r.country_code for r in got.collect()} == dict(rows)


def test_core_does_not_need_llm():
    code = "import sys; sys.modules['postloom.llm'] = None; import __spark_entry__ as e; assert 'p1_found' in e.queries() and 'p2_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=100)
    used = [p for p in (ROOT / "postloom").rglob("*.py") if "llm" not in p.parts and "postloom.llm" in p.read_text()]
    assert not used
