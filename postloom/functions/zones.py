"""Zone-offset intervals: for every IANA zone and local year the offsets in force, as a small table."""

from __future__ import annotations

import zoneinfo
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Before the first year no zone has changed its mean local time; in the last 28 years, every one of the 14 calendars occurs and only
#: the yearly rules hold that hold for ever. Years from the first to the last dense one have rows of their own, the others share decades.
FIRST_YEAR, LAST_YEAR = 1830, 2128
FIRST_DENSE, LAST_DENSE = 1970, 2060
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_STEP = 10 * 86400
_FAR = 1 << 40


def _offset(zone: zoneinfo.ZoneInfo, second: int) -> int:
    return int((_EPOCH + timedelta(seconds=second)).astimezone(zone).utcoffset().total_seconds())


@lru_cache(maxsize=None)
def intervals(name: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> tuple[tuple[int, int, int], ...]:
    """(UTC start, UTC end, offset) in seconds for one zone; the first and the last interval are open-ended."""
    zone = zoneinfo.ZoneInfo(name)
    low = int((datetime(first_year, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds())
    high = int((datetime(last_year + 1, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds())
    cuts, offsets = [-_FAR], [_offset(zone, low)]
    before, here = low, offsets[0]
    for after in range(low + _STEP, high + _STEP, _STEP):
        there = _offset(zone, after)
        while there != here:  # the change lies in (before, after]
            a, b = before, after
            while b - a > 1:
                middle = (a + b) // 2
                a, b = (middle, b) if _offset(zone, middle) == here else (a, middle)
            here = _offset(zone, b)
            cuts.append(b)
            offsets.append(here)
            before = b
        before = after
    ends = [*cuts[1:], _FAR]
    return tuple(zip(cuts, ends, offsets))


@lru_cache(maxsize=None)
def _rows(name: str, first_year: int, last_year: int) -> tuple[tuple, ...]:
    """The interval rows of one zone, each once for every local year or decade it touches."""
    starts = [int((datetime(y, 1, 1, tzinfo=timezone.utc) - _EPOCH).total_seconds()) for y in range(first_year, last_year + 2)]
    decades = [(y, y + 9) for y in range(FIRST_YEAR, FIRST_DENSE, 10)] + [(y, y + 9) for y in range(LAST_DENSE + 1, LAST_YEAR + 1, 10)]
    blocks = [(y, y) for y in range(FIRST_DENSE, LAST_DENSE + 1)] + decades
    spans = intervals(name, first_year, last_year)
    local = [(s + o, e + o, o) for s, e, o in spans]
    rows = []
    for first, last in blocks:
        if last < first_year or first > last_year:
            continue
        low = -_FAR if first <= first_year else starts[first - first_year] - 2 * 86400
        high = _FAR if last >= last_year else starts[last - first_year + 1] + 2 * 86400
        for i, (start, end, offset) in enumerate(local):
            until = local[i + 1][0] if i + 1 < len(local) else 2 * _FAR
            if start < high and until > low:
                before_end, before_offset = local[i - 1][1:] if i else (-2 * _FAR, offset)
                rows.append((name, first, -2 * _FAR if i == 0 else start, until, end, offset, before_end, before_offset))
    return tuple(rows)


def place_in_time(year: Column) -> tuple[Column, Column]:
    """The ``local_year`` in :func:`zone_table` of any year, and the days by which its moments lie behind the year read there.

    Years after the last one are read as the one of the last 28 that has the same calendar.
    """
    same = {}
    for y in range(LAST_YEAR - 27, LAST_YEAR + 1):
        first = datetime(y, 1, 1)
        same[(first.isoweekday() % 7 + 1) * 2 + int((datetime(y + 1, 1, 1) - first).days == 366)] = y
    new_year = F.make_date(year, F.lit(1), F.lit(1))
    leap = ((year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))).cast("int")
    like = F.create_map(*[F.lit(x) for pair in same.items() for x in pair])[F.dayofweek(new_year) * 2 + leap]
    read = F.when(year > LAST_YEAR, like).otherwise(F.greatest(year, F.lit(FIRST_YEAR)))
    behind = F.when(year > LAST_YEAR, F.unix_date(new_year) - F.unix_date(F.make_date(like, F.lit(1), F.lit(1)))).otherwise(0)
    decade = F.when(read < FIRST_DENSE, read - read % 10).when(read > LAST_DENSE, read - (read - LAST_DENSE - 1) % 10).otherwise(read)
    return decade.cast("int"), behind


INTERVAL = "zone_id string, local_year int, local_start bigint, until bigint, local_end bigint, offset_s int, before_end bigint, before_offset_s int"


def zone_table(spark: SparkSession, names: list[str], first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """The intervals of every named zone, exploded to the local years or decades they touch: columns of :data:`INTERVAL`.

    ``local_year`` is as :func:`place_in_time` gives it. Each interval stands with the local second at which the next one begins
    (``until``), so exactly one row of a zone and year is the last to begin at or before a given second; ``local_end`` says whether
    that interval holds the second too, ``before_end`` whether the one before it still does. Its size is bounded by the names given
    times the years; a zone has at most a few changes a year. Unknown names are left out.
    """
    known = sorted(set(names) & zoneinfo.available_timezones())
    rows = [row for name in known for row in _rows(name, first_year, last_year)]
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in INTERVAL.split(", ")])
    return spark.createDataFrame(frame, INTERVAL) if rows else spark.createDataFrame([], INTERVAL)
