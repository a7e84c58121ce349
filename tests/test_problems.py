"""The general training-data operators against brute force and on odd inputs."""

import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from postloom.functions.zones import intervals
from postloom.operators.joins import sized_join
from postloom.operators.packed import packed_values, split_packed
from postloom.operators.snapshots import bare_key, bare_sha256, snapshot_changes
from postloom.operators.timestamps import to_utc

ROWS = "g bigint, s int, k string, h string, extra string, at bigint, _g string"


def _changes(spark, rows, snaps, fields=("h",)):
    got = snapshot_changes(
        spark.createDataFrame(rows, ROWS), spark.createDataFrame(snaps, "g bigint, s int"), group="g", sequence="s", key="k", fields=list(fields), order="at"
    )
    return sorted((r.g, r.s, r.k, r.change_kind, tuple(r.changed_fields)) for r in got.collect())


def _brute(rows, snaps):
    last = {}
    for g, s, k, h, _, at, _ in rows:
        if None not in (g, s, k) and (g, s) in snaps:
            rank = (at is not None, at or 0, h is not None, h or "")
            if (g, s, k) not in last or rank > last[(g, s, k)][0]:
                last[(g, s, k)] = (rank, h)
    out = []
    for g in {g for g, _ in snaps}:
        numbers = sorted({s for b, s in snaps if b == g})
        for before, after in zip(numbers, numbers[1:]):
            old = {k: v[1] for (b, s, k), v in last.items() if (b, s) == (g, before)}
            new = {k: v[1] for (b, s, k), v in last.items() if (b, s) == (g, after)}
            for k in old.keys() | new.keys():
                if k not in old:
                    out.append((g, after, k, "added", ()))
                elif k not in new:
                    out.append((g, after, k, "removed", ()))
                elif None not in (old[k], new[k]) and old[k] != new[k]:
                    out.append((g, after, k, "changed", ("h",)))
    return sorted(out)


def test_snapshot_changes_against_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 1, 1, 2, None]), rng.choice([1, 2, 4, 5, None]), rng.choice(["a", "b", "c", "", None]), rng.choice(["x", "y", None]), "e", rng.choice([1, 2, 3, None]), "q")
        for _ in range(400)
    ]
    snaps = [(1, 1), (1, 2), (1, 5), (1, 5), (2, 1), (2, 4), (3, 1), (3, 2)]
    got = _changes(spark, rows, snaps)
    assert got == _brute(rows, set(snaps)) and got


def test_snapshot_changes_empty(spark):
    assert _changes(spark, [], []) == []
    assert _changes(spark, [(1, 1, "a", "x", "", 1, "")], [(1, 1), (1, 2)]) == [(1, 2, "a", "removed", ())]


def test_keys_and_hashes(spark):
    digest = "AB" * 32
    row = spark.createDataFrame([(" \tu-1 ", f"sha256:{digest} ", "x" * 10)], "u string, h string, n string").select(bare_key("u"), bare_sha256("h"), bare_sha256("n")).first()
    assert tuple(row) == ("u-1", digest.lower(), None)


def test_sized_join_both_ways(spark):
    big = spark.range(100).select(F.when(F.col("id") < 90, 1).otherwise(F.col("id")).alias("k"), "id")
    small = spark.createDataFrame([(1, "one"), (95, "n")], "k bigint, name string")
    want = sorted(map(tuple, big.join(small, ["k"], "left").select("id", "name").collect()))
    for limit in (1 << 20, 0):
        got = sized_join(big, small, ["k"], "left", spread_by="id", limit=limit)
        assert sorted(map(tuple, got.select("id", "name").collect())) == want


WRITTEN = [
    ("2026-05-05T00:34:25+02:00", "UTC", False, "2026-05-04T22:34:25"),
    ("2026-03-29 02:30:00", "Europe/Berlin", False, "2026-03-29T01:30:00"),  # skipped: moves on
    ("2025-10-26 02:30:00", "Europe/Berlin", False, "2025-10-26T00:30:00"),  # repeated: the first
    ("2025-10-26 02:30 CET", "Europe/Berlin", False, "2025-10-26T01:30:00"),
    ("03/04/2026", "America/New_York", True, "2026-03-04T00:00:00"),
    ("03/04/2026", "America/New_York", False, "2026-04-03T00:00:00"),
    ("10/01/2026 5:39 AM", "America/Chicago", True, "2026-10-01T10:39:00"),
    ("12/26/2025 12:46 PM", None, True, "2025-12-26T12:46:00"),
    ("17. September 2025, 00:09 Uhr", "Europe/Berlin", False, "2025-09-16T22:09:00"),
    ("29 décembre 2025 à 20h35", "Europe/Paris", False, "2025-12-29T19:35:00"),
    ("18 de septiembre de 2026, 05:40", None, False, "2026-09-18T05:40:00"),
    ("2025年7月10日 03:20", "Asia/Tokyo", False, "2025-07-09T18:20:00"),
    ("1766061322000", "Asia/Tokyo", False, "2025-12-18T12:35:22"),
    ("1757219519.226", None, False, "2025-09-07T04:31:59.226000"),
    ("20250302T123831Z", None, False, "2025-03-02T12:38:31"),
    ("Sun, 21 Jun 2026 15:04:33 +0200", None, False, "2026-06-21T13:04:33"),
    ("2026-05-10 08:44:19 Europe/Paris", "Asia/Tokyo", False, "2026-05-10T06:44:19"),
    ("\t 2026-01-30 ", "America/Los_Angeles", False, "2026-01-30T00:00:00"),
    ("2025-07-10 11:47 IST", "Asia/Kolkata", False, "2025-07-10T06:17:00"),
    *[(v, "UTC", False, None) for v in (None, "", "-", "yesterday", "3 days ago", "Spring 2026", "2026-02-30", "2026-13-05T10:00:00Z", "0000-00-00 00:00:00", "2026-01-01 25:00", "2026-01-01 10:00 XYZ", "x" * 100000)],
]


def test_written_moments(spark):
    frame = spark.createDataFrame([(i, *w[:3], "keep", "keep") for i, w in enumerate(WRITTEN)], "i int, w string, z string, m boolean, spans string, _w string")
    got = {r.i: r for r in to_utc(frame, text="w", zone="z", month_first="m").collect()}
    for i, (written, _, _, want) in enumerate(WRITTEN):
        at = None if want is None else (datetime.fromisoformat(want + "+00:00") - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
        assert got[i].utc_us == at, written
        assert (got[i].spans, got[i]["_w"]) == ("keep", "keep")
    assert to_utc(frame.limit(0), text="w", zone="z", month_first="m").count() == 0


def test_reading_of_local_times(spark):
    """Two intervals mean a repeated hour (the first is meant), none a skipped one (moved on by the skip), one gives the offset."""
    cases = [
        ("2025-10-26 02:30", "2025-10-26T00:30", "repeated"), ("2025-03-30 02:30", "2025-03-30T01:30", "skipped"), ("2025-07-01 12:00", "2025-07-01T10:00", "direct"),
        ("2025-10-26 02:30 +01:00", "2025-10-26T01:30", "stated"), ("2025-10-26", "2025-10-26T00:00", "day"), ("1761438600", "2025-10-26T00:30", "epoch"), ("soon", None, None), (None, None, None),
    ]
    frame = spark.createDataFrame([(i, t, "Europe/Berlin", False, 1, 2) for i, (t, _, _) in enumerate(cases)], "i int, w string, z string, m boolean, until int, zone_id int")
    got = {r.i: r for r in to_utc(frame, text="w", zone="z", month_first="m", reading="how").collect()}
    for i, (_, moment, how) in enumerate(cases):
        want = None if moment is None else int(datetime.fromisoformat(moment + "+00:00").timestamp()) * 1000000
        assert (got[i].utc_us, got[i].how, got[i].until, got[i].zone_id) == (want, how, 1, 2), cases[i]


def test_packed_values_in_linear_time(spark):
    """Spans are found once a text: 8,000 values in quotes come out whole, in order."""
    text = "; ".join(f'"A {i}; b"' for i in range(8000))
    frame = spark.createDataFrame([(1, text)], "i int, t string")
    rows = split_packed(frame, "t").select("pos", "piece").orderBy("pos").collect()
    assert len(rows) == 8000 and rows[7999].piece == "A 7999; b" and rows[7999].pos == 8000


@pytest.mark.parametrize("name", ["Europe/Berlin", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "Africa/Casablanca"])
def test_intervals_against_the_zone(name):
    rng, zone = random.Random(5), ZoneInfo(name)
    spans = intervals(name)
    for _ in range(300):
        second = rng.randrange(0, 2500000000)
        want = datetime.fromtimestamp(second, timezone.utc).astimezone(zone).utcoffset().total_seconds()
        assert [o for s, e, o in spans if s <= second < e] == [want]


def test_written_moments_of_all_years(spark):
    rng, rows = random.Random(8), []
    zones = ["Europe/Berlin", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe", "Africa/Casablanca", "America/Sao_Paulo", "Asia/Manila"]
    for year in [1, 1700, 1835, 1845, 1890, *range(1900, 1970, 3), *range(2058, 2135, 2), 2200, 2400, 3000, 4567, 9998]:
        for zone in zones:
            for _ in range(4):
                local = datetime(year, 1, 1) + timedelta(seconds=rng.randrange(365 * 86400))
                there = local.replace(tzinfo=ZoneInfo(zone))
                if there.utcoffset() != there.replace(fold=1).utcoffset():
                    continue
                rows.append((local.strftime("%Y-%m-%dT%H:%M:%S").zfill(19), zone, (local - there.utcoffset() - datetime(1970, 1, 1)) // timedelta(microseconds=1)))
    rows += [("2061-07-01 12:00", "Europe/Berlin", 2887437600 * 10**6), ("1969-07-01 12:00", "America/New_York", -15840000 * 10**6)]
    got = to_utc(spark.createDataFrame(rows, "w string, z string, want bigint").selectExpr("*", "false as m"), text="w", zone="z", month_first="m", zones=zones).collect()
    assert [(r.w, r.z) for r in got if r.utc_us != r.want] == []


PACKED = [
    ("A-Town; B-Town", ["A-Town", "B-Town"]),
    ("Mühlelswörth, Germany || Hybrid - Walderijssel | North Griniswick", ["Mühlelswörth, Germany", "Hybrid - Walderijssel", "North Griniswick"]),
    ('West, "Office ""The Kiln"", Fennisford"', ["West", 'Office "The Kiln", Fennisford']),
    ('["Högenstad, LR","Łąlsław"]', ["Högenstad, LR", "Łąlsław"]),
    ("['Broekerrode', 'Nordenheim, FK']", ["Broekerrode", "Nordenheim, FK"]),
    ('{Granaborg,"Tunafjäll, XH"}', ["Granaborg", "Tunafjäll, XH"]),
    ("(1) Staningport (2) Remote - Brazil (3) Hasloridge", ["Staningport", "Remote - Brazil", "Hasloridge"]),
    ("1. Caldingport 2. West – Building 3 3. Couremont, YC, France", ["Caldingport", "West – Building 3", "Couremont, YC, France"]),
    ("- Remote (GB)\n- Alpha, HS", ["Remote (GB)", "Alpha, HS"]),
    ("Kaltelfurt, Alpha and Beta", ["Kaltelfurt", "Alpha and Beta"]),
    ("Stanerwick, Drexaport et Frauenwörth", ["Stanerwick", "Drexaport", "Frauenwörth"]),
    ("Wysowęcin\\, OP, Yonenodera\\, Japan", ["Wysowęcin, OP", "Yonenodera, Japan"]),
    ("Hybrid (2 days/week), Corvleton", ["Hybrid (2 days/week), Corvleton"]),
    ("24/7 site, Staningport", ["24/7 site, Staningport"]),
    ("Clairemont, Unit 4/7", ["Clairemont, Unit 4/7"]),
    ("One;;Two; ;", ["One", "Two"]),
    ("Same\nSame", ["Same", "Same"]),
    ("a  b; 0", ["a  b", "0"]),
    ("", []),
    ("  ", []),
    (None, None),
]


def test_packed_values(spark):
    frame = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PACKED)], "i int, t string")
    got = {r.i: r.v for r in frame.select("i", packed_values(F.col("t"), compounds=["Alpha and Beta"], qualifiers=["Germany", "France", "Japan"]).alias("v")).collect()}
    for i, (text, want) in enumerate(PACKED):
        assert got[i] == want, text


def test_split_packed_rows(spark):
    long = "; ".join(f"Town{i}" for i in range(5000))
    frame = spark.createDataFrame([(1, "a; b", "x", 9), (1, "a; b", "x", 9), (2, None, "x", 9), (3, long, "x", 9), (4, "solo", "x", 9)], "id int, t string, piece string, pos int")
    got = split_packed(frame, "t", least=2)
    assert got.columns == ["id", "t", "pos", "piece"]
    rows = [(r.id, r.pos, r.piece) for r in got.collect()]
    assert sorted(r for r in rows if r[0] == 1) == [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (1, 2, "b")]
    assert sum(r[0] == 3 for r in rows) == 5000 and not [r for r in rows if r[0] in (2, 4)]
    assert split_packed(frame.limit(0), "t").count() == 0
