"""What changed between consecutive full snapshots.

Every snapshot is unpivoted into signed cells: a record counts +1 for the transition into its own snapshot and -1 for the
transition into the next one. A cell is (key, field, value); besides the fields each record has one presence cell. Cells that
are equal on both sides cancel, so the nonzero sums of a key say what happened to it and in which fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators.joins import sized_join

_SPACE = "[\\s\\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]+"


def bare_key(value: Column | str) -> Column:
    """The text without surrounding white space of any kind; null when nothing is left."""
    text = F.col(value) if isinstance(value, str) else value
    return F.nullif(F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", ""), F.lit(""))


def bare_sha256(value: Column | str) -> Column:
    """The 64 hex digits of a written SHA-256 in lower case, whatever stands around them; null without them."""
    text = F.col(value) if isinstance(value, str) else value
    digits = F.regexp_extract(F.lower(text), "(?<![0-9a-f])[0-9a-f]{64}(?![0-9a-f])", 0)
    return F.nullif(digits, F.lit(""))


def snapshot_changes(
    rows: DataFrame,
    snapshots: DataFrame,
    *,
    group: str,
    sequence: str,
    key: str,
    fields: list[str],
    order: str,
) -> DataFrame:
    """Records that were added, removed or changed between each snapshot of a group and the group's previous one.

    ``snapshots`` lists the snapshots that count as (``group``, ``sequence``), also those without records; rows of other
    snapshots are left out. ``rows`` has ``group``, ``sequence``, ``key``, ``fields`` and ``order``; of several rows of a key
    in a snapshot the one with the greatest ``order`` counts (ties: the greatest field values, so that reruns agree).

    Returns ``group``, ``sequence`` (of the later snapshot), ``key``, ``change_kind`` (added, removed, changed) and
    ``changed_fields`` (sorted; empty but for changed).

    Defined results: rows with a null group, sequence or key are no records. A null field value is unknown: a field counts
    as changed only with known values on both sides. Repeated rows and repeated snapshots count once. Empty inputs give no
    rows. Extra columns are ignored. The first snapshot of a group gives none.

    One shuffle of the rows: they are placed by (group, key), which serves the choice of the last row, the cell sums and
    the classification alike; a hot group is spread by its keys.
    """
    turns = (
        snapshots.select(F.col(group).alias("_g"), F.col(sequence).alias("_s"))
        .where("_g is not null and _s is not null")
        .distinct()
    )
    by_group = Window.partitionBy("_g").orderBy("_s")
    turns = turns.select(
        "_g",
        "_s",
        F.lag("_s").over(by_group).isNotNull().alias("_has_before"),
        F.lead("_s").over(by_group).alias("_next"),
    )
    records = rows.select(
        F.col(group).alias("_g"),
        F.col(sequence).alias("_s"),
        F.col(key).alias("_k"),
        F.struct(F.col(order).alias("_at"), *[F.col(f).cast("string").alias(f"_f{i}") for i, f in enumerate(fields)]).alias("_row"),
    ).where("_g is not null and _s is not null and _k is not null")
    placed = sized_join(records, turns, ["_g", "_s"], "inner", spread_by="_k").repartition("_g", "_k")
    last = placed.groupBy("_g", "_k", "_s").agg(
        F.max("_row").alias("_row"), F.first("_has_before").alias("_has_before"), F.first("_next").alias("_next")
    )
    sides = F.array(
        F.struct(F.when(F.col("_has_before"), F.col("_s")).alias("turn"), F.lit(1).alias("sign")),
        F.struct(F.col("_next").alias("turn"), F.lit(-1).alias("sign")),
    )
    cells = F.array(
        F.struct(F.lit(-1).alias("field"), F.lit("").alias("value")),
        *[F.struct(F.lit(i).alias("field"), F.col(f"_row._f{i}").alias("value")) for i in range(len(fields))],
    )
    signed = (
        last.select("_g", "_k", F.explode(sides).alias("_side"), cells.alias("_cells"))
        .where("_side.turn is not null")
        .select("_g", "_k", F.col("_side.turn").alias("_t"), F.col("_side.sign").alias("_n"), F.explode("_cells").alias("_c"))
        .where("_c.value is not null")
    )
    sums = signed.groupBy("_g", "_k", "_t", F.col("_c.field").alias("_f"), F.col("_c.value").alias("_v")).agg(F.sum("_n").alias("_n"))
    found = (
        sums.where("_n <> 0")
        .groupBy("_g", "_k", "_t")
        .agg(
            F.coalesce(F.sum(F.when(F.col("_f") == -1, F.col("_n"))), F.lit(0)).alias("_presence"),
            F.collect_set(F.when((F.col("_f") >= 0) & (F.col("_n") > 0), F.col("_f"))).alias("_new"),
            F.collect_set(F.when((F.col("_f") >= 0) & (F.col("_n") < 0), F.col("_f"))).alias("_old"),
        )
    )
    both = F.array_sort(F.array_intersect("_new", "_old"))
    names = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    return (
        found.withColumn("_both", both)
        .where((F.col("_presence") != 0) | (F.size("_both") > 0))
        .select(
            F.col("_g").alias(group),
            F.col("_t").alias(sequence),
            F.col("_k").alias(key),
            F.when(F.col("_presence") > 0, "added").when(F.col("_presence") < 0, "removed").otherwise("changed").alias("change_kind"),
            F.when(F.col("_presence") == 0, F.transform("_both", lambda i: F.element_at(names, i + 1)))
            .otherwise(F.array().cast("array<string>"))
            .alias("changed_fields"),
        )
    )
