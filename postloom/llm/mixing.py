"""Mixing sources to target shares by Pareto order sampling.

The largest total that no source's repeats forbid fixes how many tokens each source gives. Certain whole copies come first; the
rest of a source is a fixed-size sample in Pareto order: documents are ranked by random odds divided by inclusion odds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators.joins import sized_join
from postloom.session import checkpoint_ready

#: Ranks are cut into slices of about this many documents; only the slice in which a source's budget ends is ordered row by row.
SLICE = 2000
#: After the prefix of the order, what is left of a budget is filled so many times by the documents that still fit.
FILLS = 2


def _uniform(seed: int, *columns: str) -> Column:
    """A reproducible number in (0, 1) for each row, the same on every attempt of a task."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def _slice(rank: Column, slices: int) -> Column:
    """A slice number that grows with the rank: ranks are ratios of odds, so r / (1 + r) lies in (0, 1)."""
    return F.least(F.floor(rank / (1 + rank) * slices), F.lit(slices - 1))


def mix_plan(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(``mix_name``, ``source``, ``target_share``, ``max_repeats``, ``have_tokens``, ``have_weight``, ``give_tokens``): what each source gives.

    ``give_tokens`` is the share of the largest total at which no source needs more than ``max_repeats`` copies. A source
    that is wanted but has no tokens makes that total 0. Shares that are null or not positive are left out; the others are
    divided by their sum. Of targets that contradict each other the greatest share counts.
    """
    have = documents.groupBy("source").agg(F.sum("tokens").alias("have_tokens"))
    wanted = targets.where("target_share > 0 and max_repeats > 0").groupBy("mix_name", "source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("mix_name", "source", "t.*")
    by_mix = Window.partitionBy("mix_name")
    shares = wanted.withColumn("share", F.col("target_share") / F.sum("target_share").over(by_mix)).join(have, "source", "left")
    shares = shares.withColumn("have_tokens", F.coalesce("have_tokens", F.lit(0)))
    total = F.min(F.col("have_tokens") * F.col("max_repeats") / F.col("share")).over(by_mix)
    return shares.withColumn("give_tokens", total * F.col("share")).select(
        "mix_name", "source", F.col("share").alias("target_share"), "max_repeats", "have_tokens", "give_tokens"
    )


def _prefix(ranked: DataFrame) -> DataFrame:
    """``ranked`` with ``extra``: 1 for the longest prefix of each source's order that keeps to its ``room`` of tokens, else 0."""
    sums = ranked.groupBy("mix_name", "source", "slice").agg(F.sum("tokens").alias("t"))
    before = Window.partitionBy("mix_name", "source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0)))
    rows = ranked.join(sums, ["mix_name", "source", "slice"])
    inside = rows.where("before + t <= room").withColumn("extra", F.lit(1))
    edge = rows.where("before + t > room and before < room")
    order = Window.partitionBy("mix_name", "source", "slice").orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("extra", (F.col("before") + F.sum("tokens").over(order) <= F.col("room")).cast("int"))
    beyond = rows.where("before + t > room and before >= room").withColumn("extra", F.lit(0))
    return inside.unionByName(edge).unionByName(beyond).drop("t", "before")


def mix_documents(
    documents: DataFrame, targets: DataFrame, *, key: str = "doc_id", weight: str | None = None, seed: int = 11
) -> DataFrame:
    """(``mix_name``, ``source``, ``key``, ``tokens``, ``copies``): how often each document is used in each mix; only used ones.

    ``documents`` has a unique ``key``, ``source`` and ``tokens``; ``targets`` has ``mix_name``, ``source``, ``target_share``, ``max_repeats``.
    Every document gets the certain whole copies of its source; the tokens still missing come from a Pareto order sample with
    inclusion probability in proportion to ``weight`` (all alike without it). The sample is the longest prefix of the order
    that keeps to the budget, so a source misses its tokens by less than one document; as that one may be huge, the rest is filled
    ``FILLS`` times by the next documents that are not larger than it.

    Documents without source or tokens are in no mix; null weights count 1; repeated targets count once; empty inputs give no
    rows; extra columns are ignored. Sources may hold any part of the rows: sums are combined before the shuffle, and the
    order is worked out by slices of the rank, so only rows of one slice a source meet in a task.
    """
    checkpoint_ready(documents.sparkSession)
    known = documents.select(
        F.col(key).alias("id"), "source", "tokens", F.greatest(F.coalesce(F.col(weight) if weight else F.lit(1.0), F.lit(1.0)), F.lit(1e-9)).cast("double").alias("w")
    ).where("source is not null and tokens > 0")
    plan = mix_plan(known, targets).checkpoint()
    mean = known.groupBy("source").agg((F.sum(F.col("w") * F.col("tokens")) / F.sum("tokens")).alias("mean_w"))
    plan = plan.join(mean, "source").withColumn("whole", F.floor(F.try_divide("give_tokens", "have_tokens")))
    plan = plan.withColumn("whole", F.least("whole", "max_repeats")).withColumn("budget", F.col("give_tokens") - F.col("whole") * F.col("have_tokens"))
    ranked = sized_join(known, plan.checkpoint(), ["source"], "inner", spread_by="id")
    chance = F.least(F.greatest(F.try_divide("budget", "have_tokens") * F.col("w") / F.col("mean_w"), F.lit(1e-12)), F.lit(1 - 1e-9))
    slices = max(64, math.ceil(known.count() / SLICE))
    u = _uniform(seed, "mix_name", "id")
    ranked = ranked.withColumn("rank", (u / (1 - u)) / (chance / (1 - chance))).withColumn("slice", _slice(F.col("rank"), slices))
    used = _prefix(ranked.select("mix_name", "source", "id", "tokens", "whole", "max_repeats", "budget", "rank", "slice", F.col("budget").alias("room")))
    for _ in range(FILLS):
        used = used.drop("room").checkpoint()
        left = used.groupBy("mix_name", "source").agg((F.min("budget") - F.sum(F.col("tokens") * F.col("extra"))).alias("room"))
        used = used.join(left, ["mix_name", "source"]).withColumn("fits", (F.col("extra") == 0) & (F.col("tokens") <= F.col("room")))
        more = _prefix(used.where("fits").drop("extra", "fits"))
        used = used.where("not fits").drop("fits").unionByName(more)
    used = used.withColumn("copies", (F.col("whole") + F.when(F.col("whole") < F.col("max_repeats"), F.col("extra")).otherwise(0)).cast("int"))
    return used.where("copies > 0").select("mix_name", "source", F.col("id").alias(key), "tokens", "copies")


def mix_report(mixed: DataFrame, documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(``mix_name``, ``source``, ``target_share``, ``reached_share``, ``n_tokens``, ``most_copies``) of every target."""
    plan = mix_plan(documents.where("source is not null and tokens > 0"), targets)
    got = mixed.groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    rows = plan.join(got, ["mix_name", "source"], "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
    total = F.sum("n_tokens").over(Window.partitionBy("mix_name"))
    return rows.select(
        "mix_name", "source", "target_share", F.when(total > 0, F.col("n_tokens") / total).alias("reached_share"), "n_tokens", F.coalesce("most_copies", F.lit(0)).alias("most_copies")
    )
