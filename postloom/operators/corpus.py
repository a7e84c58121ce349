"""The stored corpus: change-only writes, snapshot diff and closure, board verdicts, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.session import checkpoint_ready


def change_only(incoming: DataFrame, stored: DataFrame, keys: list[str], hash_column: str) -> DataFrame:
    """``incoming`` with ``change``: ``new``, ``updated`` or ``unchanged`` against the stored hash (null hashes are equal)."""
    prior = stored.select(*keys, F.col(hash_column).alias("_hash"), F.lit(True).alias("_seen"))
    same = F.col(hash_column).eqNullSafe(F.col("_hash"))
    return (
        incoming.join(prior, keys, "left")
        .withColumn("change", F.when(F.col("_seen").isNull(), "new").when(same, "unchanged").otherwise("updated"))
        .drop("_hash", "_seen")
    )


def restamp(listings: DataFrame, seen: list[str], now: Column, hours: int = 6) -> DataFrame:
    """The rows last seen (by the greatest of ``seen``) at least ``hours`` before ``now``, or never."""
    last = F.greatest(*[F.coalesce(F.col(c).cast("timestamp"), F.timestamp_seconds(F.lit(0))) for c in seen])
    return listings.where(F.unix_micros(last) <= F.unix_micros(now) - hours * 3600 * 1000000)


def closure(presence: DataFrame, passes: DataFrame, *, board: str, sequence: str, key: str) -> DataFrame:
    """The event of every record in every complete pass of its board: ``new``, ``reopened``, ``first_miss`` or ``closed``.

    ``passes`` holds the complete passes (``board``, ``sequence``), ``presence`` the records seen in them. A record missing once
    is a first miss, missing in two consecutive complete passes closed (once); seen again after closing it is reopened.
    Unchanged presence gives no row.

    Only the passes where something can happen are generated: for each run of presence its first pass and the two after it.
    """
    order = Window.partitionBy(board).orderBy(sequence)
    numbered = passes.select(board, sequence).distinct().withColumn("_n", F.row_number().over(order)).withColumn("_last", F.count("*").over(Window.partitionBy(board)))
    seen = presence.select(board, sequence, key).distinct().join(numbered, [board, sequence])
    by_key = Window.partitionBy(board, key).orderBy("_n")
    runs = seen.withColumn("_before", F.lag("_n").over(by_key)).withColumn("_after", F.lead("_n").over(by_key))
    gap_before = F.col("_n") - F.col("_before")
    after = F.coalesce(F.col("_after"), F.col("_last") + 1)
    events = F.array_compact(
        F.array(
            F.when(F.col("_before").isNull(), F.struct(F.lit("new").alias("event"), F.col("_n").alias("n"))),
            F.when(gap_before >= 3, F.struct(F.lit("reopened").alias("event"), F.col("_n").alias("n"))),
            F.when(after - F.col("_n") >= 2, F.struct(F.lit("first_miss").alias("event"), (F.col("_n") + 1).alias("n"))),
            F.when(after - F.col("_n") >= 3, F.struct(F.lit("closed").alias("event"), (F.col("_n") + 2).alias("n"))),
        )
    )
    found = runs.select(board, key, F.explode(events).alias("e")).select(board, key, "e.event", F.col("e.n").alias("_n"))
    return found.join(numbered.select(board, sequence, "_n"), [board, "_n"]).select(board, sequence, key, "event")


def board_verdicts(rows: DataFrame, board: str, uid: str, error: str, *, declared: str | None = None, most: int = 50000) -> DataFrame:
    """Per board: rows, malformed rows, duplicate uids and the verdict that decides whether its snapshot counts.

    Verdict: TOO_MANY_JOBS, MALFORMED_JOB (none valid, or more malformed than the greater of 5 and a tenth),
    DUPLICATE_JOB_ID, INCOMPLETE_BOARD (a declared total that differs) or ok. Sums are combined before the shuffle.
    """
    good = F.col(error).isNull()
    sums = rows.groupBy(board).agg(
        F.count("*").alias("n_rows"),
        F.count_if(~good).alias("n_malformed"),
        (F.count_if(good & F.col(uid).isNotNull()) - F.count_distinct(F.when(good, F.col(uid)))).alias("n_duplicate"),
        (F.max(declared) if declared else F.lit(None).cast("int")).alias("n_declared"),
    )
    verdict = (
        F.when(F.col("n_rows") > most, "TOO_MANY_JOBS")
        .when((F.col("n_malformed") == F.col("n_rows")) | (F.col("n_malformed") > F.greatest(F.lit(5), F.floor(F.col("n_rows") * 0.1))), "MALFORMED_JOB")
        .when(F.col("n_duplicate") > 0, "DUPLICATE_JOB_ID")
        .when(F.col("n_declared") != F.col("n_rows"), "INCOMPLETE_BOARD")
        .otherwise("ok")
    )
    return sums.withColumn("verdict", verdict)


def merge_by_key(rows: DataFrame, key: list[str], order: list[str], values: str, keep: list[str]) -> DataFrame:
    """One row per key: ``keep`` of the first row in ``order`` and the sorted distinct union of the arrays in ``values``."""
    first = F.min_by(F.struct(*keep), F.struct(*order)).alias("_first")
    union = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(values, F.array().cast("array<string>")))))).alias(values)
    return rows.groupBy(*key).agg(first, union).select(*key, "_first.*", values)


def within_bytes(rows: DataFrame, group: str, order: list[str], text: str, cap: int) -> DataFrame:
    """``rows`` with ``bytes_so_far`` and ``fits``: the running UTF-8 bytes of ``text`` in a group against ``cap``.

    Null texts have no bytes. Rows are placed by ranges of (group, order), so a hot group lies in several parts; each part is
    summed, the sums of the parts before it are added. The placing is checkpointed, as both steps must see the same parts.
    ``order`` must tell rows apart for the result to be the same on every run.
    """
    spark = rows.sparkSession
    checkpoint_ready(spark)
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("bytes_so_far", "fits")]).alias("_row")
    sized = rows.select(whole, F.col(group).alias("_g"), F.struct(*order).alias("_o"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("_b"))
    placed = sized.repartitionByRange(parts, "_g", "_o").withColumn("_p", F.spark_partition_id()).checkpoint()
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_g", "_p").agg(F.sum("_b").alias("_t")).select("_g", "_p", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    so_far = Window.partitionBy("_g", "_p").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumn("_here", F.sum("_b").over(so_far)).join(sums.toDF("_sg", "_sp", "_before"), F.col("_g").eqNullSafe(F.col("_sg")) & (F.col("_p") == F.col("_sp")))
    total = F.col("_here") + F.col("_before")
    return inside.select("_row.*", total.alias("bytes_so_far"), (total <= cap).alias("fits"))


def carried_forward(rows: DataFrame, key: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``out``: the first known ``value`` of the key so far; a value once known is kept."""
    so_far = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.first(value, ignorenulls=True).over(so_far))
