"""The stream forms give what the batch forms give."""

import json

from pyspark.sql import functions as F

from postloom.operators.corpus import closure
from postloom.operators.scheduling import schedule_after_polls
from postloom.sources.boards import BoardSource
from postloom.streaming.state import ROCKSDB, closure_stream, schedule_stream


def _run(spark, rows, folder, make):
    rows.write.parquet(f"{folder}/in")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    query = make(stream).writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    return spark.read.parquet(f"{folder}/out")


def test_schedule_stream_equals_batch(spark, tmp_path):
    rows = [(b, f"2026-01-0{d + 1} 00:00:00", (b * d) % 3 == 0, (b + d) % 4 == 0) for b in range(4) for d in range(6)]
    polls = spark.createDataFrame(rows, "board_id bigint, t string, changed boolean, failed boolean").select("board_id", F.to_timestamp("t").alias("source_checked_at"), "changed", "failed")
    out = _run(spark, polls, tmp_path, schedule_stream)
    last = out.groupBy("board_id").agg(F.max_by(F.struct("poll_interval_seconds", "change_rate_ema", "consecutive_failures"), "source_checked_at").alias("s")).select("board_id", "s.*")
    batch = schedule_after_polls(polls, "board_id", "source_checked_at", "changed", "failed").drop("next_due_at")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, batch.collect()))


def test_closure_stream_equals_batch(spark, tmp_path):
    seen = {1: ["a", "b"], 2: ["a"], 3: ["a", "c"], 4: ["b"], 5: [], 6: ["a", "b", "c"]}
    rows = [(1, n, u) for n, uids in seen.items() for u in [*uids, None]]
    frame = spark.createDataFrame(rows, "board_id bigint, snapshot_no int, uid string")
    out = _run(spark, frame.coalesce(1), tmp_path, lambda s: closure_stream(s, 3))
    batch = closure(frame.where("uid is not null"), frame.where("uid is null"), board="board_id", sequence="snapshot_no", key="uid")
    got = sorted((r.snapshot_no, r.uid, r.event) for r in out.collect())
    assert got == sorted((r.snapshot_no, r.uid, r.event) for r in batch.collect())
    assert (3, "b", "closed") in got and (4, "b", "reopened") in got and (2, "b", "first_miss") in got


def test_board_source_limits(spark, tmp_path):
    def put(source, board, *pages):
        folder = tmp_path / source / board
        folder.mkdir(parents=True)
        for i, page in enumerate(pages):
            (folder / f"{i:03}.json").write_bytes(page)

    put("greenhouse", "one", json.dumps({"jobs": [{"id": 1}]}).encode())
    put("greenhouse", "two", b"{}", b"{}")
    put("lever", "paged", b"[1]", b"[2]", b"[]")
    put("ashby", "bad", b"\xff\xfe")
    put("breezy", "empty", b" ")
    put("pinpoint", "odd", b"{oops")
    spark.dataSource.register(BoardSource)
    rows = spark.read.format("posting_boards").load(str(tmp_path)).collect()
    errors = {(r.source, r.board): r.error for r in sorted(rows, key=lambda r: r.page_no)}
    assert errors == {
        ("greenhouse", "one"): None, ("greenhouse", "two"): "UNEXPECTED_PAGINATION", ("lever", "paged"): None, ("ashby", "bad"): "INVALID_ENCODING",
        ("breezy", "empty"): "EMPTY_RESPONSE", ("pinpoint", "odd"): "INVALID_JSON",
    }
