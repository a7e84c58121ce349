"""The queries of the training-data operators; their SQL is in ``ORACLES`` where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.canonical import map_values, place_entries
from postloom.llm.lookalikes import consistent_texts, odd_texts
from postloom.llm.mixing import mix_documents, mix_report
from postloom.llm.neardup import similar_groups, similar_pairs
from postloom.llm.packing import pack_documents, pack_report, part_report
from postloom.llm.sentences import sentence_units
from postloom.llm.tokens import sized_documents
from postloom.operators.joins import sized_join
from postloom.session import checkpoint_ready
from postloom.sources.tables import table


def job_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(job_id, field_name, pos, text): every title (pos 0) and every location label (pos from 1) of source_jobs."""
    jobs = table(spark, folder, "source_jobs")
    titles = F.array(F.struct(F.lit("title").alias("field_name"), F.lit(0).alias("pos"), F.col("title").alias("text")))
    labels = F.transform(
        F.coalesce("locations", F.array().cast("array<string>")),
        lambda x, i: F.struct(F.lit("locations").alias("field_name"), (i + 1).alias("pos"), x.alias("text")),
    )
    return jobs.select("job_id", F.explode(F.concat(titles, labels)).alias("t")).select("job_id", "t.*")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return odd_texts(job_texts(spark, folder), "text").select("job_id", "field_name", "pos")


def p6_texts(spark: SparkSession, folder: str) -> DataFrame:
    return consistent_texts(job_texts(spark, folder), "text")


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_jobs").select(F.col("job_id").alias("id"), F.col("description").alias("text"), "title")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = similar_pairs(_postings(spark, folder))
    return pairs.select(F.col("id_a").alias("job_id_a"), F.col("id_b").alias("job_id_b"))


def p2_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every posting with a description, the group of reworked copies it is in and its number of links."""
    groups = similar_groups(_postings(spark, folder))
    return groups.select(F.col("id").alias("job_id"), F.col("group").alias("group_id"), "n_links")


def typed_values(spark: SparkSession, folder: str) -> DataFrame:
    """(job_id, kind, pos, text): every label of source_jobs.locations and value of location_resolutions.countries."""
    labels = table(spark, folder, "source_jobs").select("job_id", F.lit("locations").alias("kind"), F.posexplode("locations").alias("i", "text"))
    values = table(spark, folder, "location_resolutions").select("job_id", F.lit("countries").alias("kind"), F.posexplode("countries").alias("i", "text"))
    return labels.unionByName(values).select("job_id", "kind", (F.col("i") + 1).alias("pos"), "text")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The elements that are not exactly a name of one place or a country code, with the entry they mean."""
    places, countries = table(spark, folder, "places"), table(spark, folder, "countries")
    exact = places.groupBy(F.col("name").alias("text")).agg(F.count_distinct("place_id").alias("n")).where("n = 1").select(F.lit("locations").alias("kind"), "text")
    exact = exact.unionByName(countries.select(F.lit("countries").alias("kind"), F.col("country_code").alias("text"))).distinct().withColumn("exact", F.lit(True))
    cases = sized_join(typed_values(spark, folder), exact, ["kind", "text"], "left", spread_by="job_id").where("exact is null").drop("exact")
    meant = map_values(cases, place_entries(places, countries)).select("kind", "text", "ref").where("ref is not null")
    found = cases.join(meant, ["kind", "text"], "left")
    return found.select("job_id", F.col("kind").alias("field_name"), "pos", F.coalesce("ref", F.lit("none")).alias("ref"))


def p9_units(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_units(table(spark, folder, "documents").select("doc_id", "text"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    units = sentence_units(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    return units.select("doc_id", "start_pos", "end_pos")


def _pack_sizes(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    return [(r.pack_name, r.capacity_tokens) for r in table(spark, folder, "pack_sizes").orderBy("capacity_tokens").collect()]


def p7_packs(spark: SparkSession, folder: str) -> DataFrame:
    sizes = sized_documents(table(spark, folder, "documents").select("doc_id", "text"))
    return pack_documents(sizes, _pack_sizes(spark, folder))


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    packs = _pack_sizes(spark, folder)
    checkpoint_ready(spark)
    return pack_report(p7_packs(spark, folder).checkpoint(), packs)


def p7_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every partition that packs were filled in, and whether its lower bound certifies it."""
    return part_report(p7_packs(spark, folder))


def p8_mixes(spark: SparkSession, folder: str) -> DataFrame:
    checkpoint_ready(spark)
    sizes = sized_documents(table(spark, folder, "documents").select("doc_id", "source", "text")).checkpoint()
    return mix_documents(sizes, table(spark, folder, "mix_targets"), weight="tokens")


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    checkpoint_ready(spark)
    sizes = sized_documents(table(spark, folder, "documents").select("doc_id", "source", "text")).checkpoint()
    targets = table(spark, folder, "mix_targets")
    return mix_report(mix_documents(sizes, targets, weight="tokens"), sizes, targets)


QUERIES = {"p2_found": p2_found, "p2_groups": p2_groups, "p3_found": p3_found, "p6_found": p6_found, "p6_texts": p6_texts, "p7_packs": p7_packs, "p7_parts": p7_parts, "p7_report": p7_report, "p8_mixes": p8_mixes, "p8_report": p8_report, "p9_found": p9_found, "p9_units": p9_units}
#: All pairs by common three-word sequences, counted exactly; the operator proposes pairs by signatures and must find the same.
P2_SQL = r"""
WITH words AS (SELECT job_id, regexp_extract_all(lower(description), '[\p{L}\p{N}]+') AS w, list_distinct(regexp_extract_all(lower(title), '[\p{L}\p{N}]+')) AS t FROM source_jobs WHERE description IS NOT NULL),
texts AS (SELECT job_id, t, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM words WHERE len(w) >= 3 AND len(t) > 0),
rows AS (SELECT job_id, len(s) AS n, unnest(s) AS x FROM texts),
shared AS (SELECT a.job_id AS job_id_a, b.job_id AS job_id_b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM rows a JOIN rows b ON a.x = b.x AND a.job_id < b.job_id
  WHERE least(a.n, b.n) >= 0.6 * greatest(a.n, b.n) - 1e-9 GROUP BY 1, 2),
near AS (SELECT job_id_a, job_id_b FROM shared WHERE c >= 0.6 * (na + nb - c) - 1e-9)
SELECT job_id_a, job_id_b FROM near JOIN texts a ON a.job_id = job_id_a JOIN texts b ON b.job_id = job_id_b
WHERE 3 * len(list_intersect(a.t, b.t)) >= len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))
"""
ORACLES: dict[str, str] = {"p2_found": P2_SQL}
