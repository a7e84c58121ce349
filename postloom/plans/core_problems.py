"""Queries of the general training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.joins import sized_join
from postloom.operators.packed import MOST_NAMES, split_packed
from postloom.operators.snapshots import bare_key, bare_sha256, snapshot_changes
from postloom.operators.timestamps import to_utc
from postloom.sources.tables import table


def p1_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "snapshot_rows").select(
        "board_id", "snapshot_no", bare_key("uid").alias("uid"), bare_sha256("source_content_sha256").alias("source_content_sha256"), "received_at"
    )
    passes = table(spark, folder, "snapshot_passes").where("is_complete").select("board_id", "snapshot_no")
    return snapshot_changes(
        rows, passes, group="board_id", sequence="snapshot_no", key="uid", fields=["source_content_sha256"], order="received_at"
    )


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_changes(spark, folder).select("board_id", "snapshot_no", "uid", "change_kind")


P1_SQL = r"""
WITH passes AS (SELECT DISTINCT board_id, snapshot_no FROM snapshot_passes WHERE is_complete),
turns AS (SELECT board_id, snapshot_no, lag(snapshot_no) OVER w AS before_no FROM passes WINDOW w AS (PARTITION BY board_id ORDER BY snapshot_no)),
named AS (SELECT board_id, snapshot_no, regexp_replace(uid, '^\s+|\s+$', '', 'g') AS uid, received_at,
  nullif(regexp_extract(lower(source_content_sha256), '[0-9a-f]{64}'), '') AS hash FROM snapshot_rows JOIN passes USING (board_id, snapshot_no)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY board_id, snapshot_no, uid ORDER BY received_at DESC, hash DESC NULLS LAST) AS n FROM named WHERE uid <> ''),
kept AS (SELECT board_id, snapshot_no, uid, hash FROM ranked WHERE n = 1),
later AS (SELECT t.board_id, t.snapshot_no, k.uid, k.hash FROM turns t JOIN kept k USING (board_id, snapshot_no) WHERE t.before_no IS NOT NULL),
earlier AS (SELECT t.board_id, t.snapshot_no, k.uid, k.hash FROM turns t JOIN kept k ON k.board_id = t.board_id AND k.snapshot_no = t.before_no)
SELECT coalesce(l.board_id, e.board_id) AS board_id, coalesce(l.snapshot_no, e.snapshot_no) AS snapshot_no, coalesce(l.uid, e.uid) AS uid,
  CASE WHEN e.uid IS NULL THEN 'added' WHEN l.uid IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM later l FULL JOIN earlier e ON l.board_id = e.board_id AND l.snapshot_no = e.snapshot_no AND l.uid = e.uid
WHERE e.uid IS NULL OR l.uid IS NULL OR l.hash <> e.hash
"""


def p4_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Every posted_at and updated_at with its UTC instant and how it was read, null where it states none."""
    raw = table(spark, folder, "raw_postings").select("raw_id", "board_id", "posted_at", "updated_at")
    boards = table(spark, folder, "boards").select("board_id", "zone_name", (F.col("locale_tag") == "en_US").alias("month_first"))
    joined = sized_join(raw, boards, ["board_id"], "left", spread_by="raw_id")
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("written")) for c in ("posted_at", "updated_at")])
    values = joined.select("raw_id", "zone_name", "month_first", F.explode(fields).alias("v")).select("raw_id", "zone_name", "month_first", "v.*")
    return to_utc(values, text="written", zone="zone_name", month_first="month_first", reading="reading").drop("zone_name", "month_first")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_instants(spark, folder).where("utc_us is not null").select("raw_id", "field_name", "utc_us")


def p5_values(spark: SparkSession, folder: str, least: int = 1) -> DataFrame:
    """Every value of raw_postings.locations with its position; the reference lists name compounds and countries."""
    # One name more than allowed is enough to refuse the list; nothing is cut off.
    names = table(spark, folder, "places").select(F.explode(F.array("name", "alt_name")).alias("n"))
    compounds = [r.n for r in names.where(r"n rlike '\\s(and|und|et|or|oder|ou|y|og|och|&)\\s'").distinct().limit(MOST_NAMES + 1).collect()]
    lands = table(spark, folder, "countries").select(F.explode(F.concat(F.array("name", "iso3_code"), F.coalesce("other_names", F.array()))).alias("n"))
    qualifiers = [r.n for r in lands.where("n is not null").distinct().limit(MOST_NAMES + 1).collect()]
    raw = table(spark, folder, "raw_postings").select("raw_id", "locations")
    return split_packed(raw, "locations", least=least, compounds=compounds, qualifiers=qualifiers).select("raw_id", "pos", "piece")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_values(spark, folder, least=2)


QUERIES = {"p1_changes": p1_changes, "p1_found": p1_found, "p4_found": p4_found, "p4_instants": p4_instants, "p5_found": p5_found}
ORACLES = {"p1_found": P1_SQL}
