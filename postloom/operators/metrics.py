"""Rollups over passes, events and backfills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_or_zero(total: Column, n: Column) -> Column:
    """The mean rounded half up; 0 where there is nothing."""
    return F.when(n > 0, F.floor(total / n + 0.5)).otherwise(0).cast("bigint")


def event_counts(events: DataFrame, group: str, event: str, names: list[str]) -> DataFrame:
    """Per group a count column for each event name; other events are ignored, groups without any stay with zeros."""
    return events.groupBy(group).agg(*[F.count_if(F.col(event) == n).alias(f"n_{n}") for n in names])


def with_total(rows: DataFrame, group: str, sums: dict[str, Column], total_name: str = "all") -> DataFrame:
    """The sums of each group and, as group ``total_name``, of all; null groups are named ``unknown``."""
    named = rows.withColumn(group, F.coalesce(group, F.lit("unknown")))
    rolled = named.rollup(group).agg(F.grouping(group).alias("_all"), *[c.alias(n) for n, c in sums.items()])
    return rolled.withColumn(group, F.when(F.col("_all") == 1, total_name).otherwise(F.col(group))).drop("_all")


def pass_failed(n_boards: Column, n_failed: Column) -> Column:
    """Whether a pass counts as failed: more failures than the greater of 3 and five per cent of its boards."""
    return n_failed > F.greatest(F.lit(3), F.floor(n_boards * 0.05))


def counts_map(rows: DataFrame, key: str) -> DataFrame:
    """One row with the map ``counts``: rows by key; the keys are a vocabulary such as error codes."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counted.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("counts"))
