"""Stateful stream forms of the poll schedule and of the two-miss closure."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from postloom.operators.scheduling import ALPHA, CHANGED, MOST_BACKOFF, MOST_QUIET, QUIET_GROWTH

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SCHEDULE = "board_id bigint, source_checked_at timestamp, poll_interval_seconds int, change_rate_ema double, consecutive_failures int"
EVENTS = "board_id bigint, snapshot_no int, uid string, event string"


class ScheduleProcessor(StatefulProcessor):
    """Folds the polls of a board, in the order of their time within each batch, into its schedule."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("schedule", "i int, r double, n int")

    def handleInputRows(self, key, rows, timerValues):
        polls = pd.concat(list(rows)).sort_values(["source_checked_at", "changed", "failed"])
        interval, rate, failures = self.state.get() if self.state.exists() else (CHANGED, 0.0, 0)
        out = []
        for at, changed, failed in polls[["source_checked_at", "changed", "failed"]].itertuples(index=False):
            failures = failures + 1 if failed else 0
            if failed:
                interval = min(MOST_BACKOFF, CHANGED * 2 ** min(max(failures, 1), 8))
            else:
                interval = CHANGED if changed else min(MOST_QUIET, math.ceil(interval * QUIET_GROWTH))
                rate = math.floor((ALPHA * bool(changed) + (1 - ALPHA) * rate) * 10000 + 0.5) / 10000
            out.append((key[0], at, interval, rate, failures))
        self.state.update((int(interval), float(rate), int(failures)))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEDULE.split(", ")])

    def close(self) -> None:
        pass


def schedule_stream(polls: DataFrame) -> DataFrame:
    """The schedule after every poll of a stream (``board_id``, ``source_checked_at``, ``changed``, ``failed``)."""
    return polls.groupBy("board_id").transformWithStateInPandas(ScheduleProcessor(), outputStructType=SCHEDULE, outputMode="Append", timeMode="None")


class ClosureProcessor(StatefulProcessor):
    """Keeps how often each listing of a board part was missed; map state lives in the state store, not in memory."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.misses = handle.getMapState("misses", "uid string", "n int")

    def handleInputRows(self, key, rows, timerValues):
        frame = pd.concat(list(rows))
        out = []
        for number, group in frame.groupby("snapshot_no", sort=True):
            seen = set(group["uid"].dropna())
            for (uid,) in list(self.misses.keys()):
                if uid not in seen:
                    (n,) = self.misses.getValue((uid,))
                    self.misses.updateValue((uid,), (min(n + 1, 3),))
                    if n + 1 in (1, 2):
                        out.append((key[0], number, uid, "first_miss" if n == 0 else "closed"))
            for uid in sorted(seen):
                known = self.misses.containsKey((uid,))
                n = self.misses.getValue((uid,))[0] if known else 0
                if not known or n >= 2:
                    out.append((key[0], number, uid, "reopened" if known else "new"))
                self.misses.updateValue((uid,), (0,))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in EVENTS.split(", ")])

    def close(self) -> None:
        pass


def closure_stream(rows: DataFrame, parts: int = 16) -> DataFrame:
    """Listing events of a stream of complete snapshots (``board_id``, ``snapshot_no``, ``uid``; a null ``uid`` marks the pass itself).

    A board is cut into ``parts`` by its listings, so a hot board is spread; marks reach every part. All rows of a snapshot
    must come in one batch, as a complete pass is delivered at once.
    """
    marks = rows.where("uid is null").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    listings = rows.where("uid is not null").withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    both = listings.select("board_id", "part", "snapshot_no", "uid").unionByName(marks.select("board_id", "part", "snapshot_no", "uid"))
    return both.groupBy("board_id", "part").transformWithStateInPandas(ClosureProcessor(), outputStructType=EVENTS, outputMode="Append", timeMode="None")
