"""Queries of the feed-processing operators over the test tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import classify, employment, hashing, temporal, text
from postloom.operators import corpus, metrics, scheduling
from postloom.operators.joins import sized_join
from postloom.sources import adapters
from postloom.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(make):
        QUERIES[make.__name__] = make
        if sql:
            ORACLES[make.__name__] = sql
        return make

    return add


def _jobs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_jobs")


def _pick(column: str, words: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.col(column) % len(words) + 1).cast("int"))


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_B = r"\b"


@query(r"""
SELECT coalesce(source, 'all') AS source, kind, kind_source, count(*) AS n FROM (SELECT source,
  CASE WHEN structured_job_type = 'internship' THEN 'intern'
    WHEN regexp_matches(title, '(?i)\b(?:intern(?:ship)?s?|co[- ]?op|apprentice(?:ship)?)\b') THEN 'intern'
    WHEN regexp_matches(title, '(?i)\b(?:new ?grad(?:uate)?|university grad(?:uate)?|recent grad(?:uate)?|campus hire|graduate (?:program|scheme|engineer|analyst)|class of 20\d\d|early career)\b') THEN 'new_grad'
    ELSE 'other' END AS kind,
  CASE WHEN structured_job_type = 'internship' THEN 'structured' ELSE 'regex' END AS kind_source FROM source_jobs)
GROUP BY GROUPING SETS ((source, kind, kind_source), (kind, kind_source))""")
def classify_kind(spark: SparkSession, folder: str) -> DataFrame:
    jobs = _jobs(spark, folder).select(
        "source", classify.kind(F.col("title"), F.col("structured_job_type")).alias("kind"), classify.kind_source(F.col("structured_job_type")).alias("kind_source")
    )
    grouped = jobs.groupingSets([["source", "kind", "kind_source"], ["kind", "kind_source"]], "source", "kind", "kind_source").agg(F.count("*").alias("n"))
    return grouped.select(F.coalesce("source", F.lit("all")).alias("source"), "kind", "kind_source", "n")


@query(r"""
SELECT job_id, terms FROM (SELECT job_id, array_to_string(list_transform(regexp_extract_all(title, '(?i)\b(?:summer|fall|spring|winter)\s*''?(?:20)?2[5-9]\b'),
  lambda m: upper(m[1]) || lower(regexp_extract(m, '[A-Za-z]+')[2:]) || ' 20' || right(m, 2)), '|') AS terms FROM source_jobs) WHERE terms <> ''""")
def season_terms(spark: SparkSession, folder: str) -> DataFrame:
    return _jobs(spark, folder).select("job_id", F.array_join(classify.season_terms(F.col("title")), "|").alias("terms")).where("terms <> ''")


_GRADS = ["", "Class of 2027.", "Graduating in 2026", "expected graduation: 2028", "Graduating by 2025 or class of 2029"]
_VISA = ["", "We will sponsor visas.", "Unable to sponsor.", "US citizenship is required? U.S. citizenship required", "No sponsorship; citizens only", "sponsorship is available"]


@query(rf"""
SELECT job_id, try_cast(coalesce(nullif(regexp_extract(t, p, 1), ''), nullif(regexp_extract(left(d, 4000), p, 1), '')) AS INTEGER) AS grad_year,
  CASE WHEN regexp_matches(tail, '(?i)u\.?s\.? citizen(?:ship)?(?: is)? required|citizens? only') THEN 'citizenship_required'
   WHEN regexp_matches(tail, '(?i)not (?:able to )?sponsor|unable to sponsor|without (?:the need for )?sponsorship|no sponsorship|sponsorship is not available') THEN 'no'
   WHEN regexp_matches(tail, '(?i)sponsorship (?:is )?available|will sponsor|able to sponsor') THEN 'offers' ELSE 'unknown' END AS sponsorship
FROM (SELECT *, '(?i)\b(?:class of|graduating(?: in| by)?|expected graduation[:\s]*)\s*(20\d\d)\b' AS p, CASE WHEN length(d) > 8000 THEN right(d, 6000) ELSE d END AS tail FROM (
  SELECT job_id, CASE WHEN job_id % 3 = 0 THEN title || ' ' || {_sql_list(_GRADS)}[job_id % 5 + 1] ELSE title END AS t,
    description || ' ' || {_sql_list(_GRADS)}[job_id % 5 + 1] || ' ' || {_sql_list(_VISA)}[job_id % 6 + 1] AS d FROM source_jobs))""")
def graduation_and_sponsorship(spark: SparkSession, folder: str) -> DataFrame:
    """Both rules over every posting, with phrases added by its id, as the postings themselves hold none."""
    jobs = _jobs(spark, folder).select(
        "job_id",
        F.when(F.col("job_id") % 3 == 0, F.concat_ws(" ", "title", _pick("job_id", _GRADS))).otherwise(F.col("title")).alias("t"),
        F.concat(F.col("description"), F.lit(" "), _pick("job_id", _GRADS), F.lit(" "), _pick("job_id", _VISA)).alias("d"),
    )
    return jobs.select("job_id", classify.graduation_year(F.col("t"), F.col("d")).alias("grad_year"), classify.sponsorship(F.col("d")).alias("sponsorship"))


_CODE_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in employment.CODES.items())


@query(f"""
SELECT structured_type, c.t AS job_type, count(*) AS n FROM source_jobs LEFT JOIN (VALUES {_CODE_ROWS}) c(k, t)
  ON c.k = regexp_replace(lower(structured_type), '[\\s_-]', '', 'g') WHERE structured_type IS NOT NULL GROUP BY ALL""")
def structured_type_codes(spark: SparkSession, folder: str) -> DataFrame:
    jobs = _jobs(spark, folder).where("structured_type is not null")
    return jobs.groupBy("structured_type").agg(F.count("*").alias("n")).select("structured_type", employment.type_of_code(F.col("structured_type")).alias("job_type"), "n")


_LABEL_ROWS = ", ".join(f"('{w}', '{t}', '{c}')" for w, (t, c) in employment.LABELS.items())


@query(f"""
WITH l AS (SELECT structured_type AS label, count(*) AS n FROM source_jobs WHERE structured_type IS NOT NULL GROUP BY 1),
v AS (SELECT *, trim(regexp_replace(lower(label), '[\\s_/-]+', ' ', 'g')) AS value FROM l),
h AS (SELECT *, trim(regexp_extract(regexp_replace(value, '\\(.*?\\)', ' ', 'g'), '^[^,;|]*')) AS head FROM v), d(w, t, c) AS (VALUES {_LABEL_ROWS})
SELECT label, coalesce(a.t, b.t) AS job_type, coalesce(a.c, b.c) AS confidence, n FROM h LEFT JOIN d a ON a.w = value LEFT JOIN d b ON b.w = head""")
def structured_type_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = _jobs(spark, folder).where("structured_type is not null").groupBy(F.col("structured_type").alias("label")).agg(F.count("*").alias("n"))
    known = employment.type_of_label(F.col("label"))
    return labels.select("label", known["type"].alias("job_type"), known["confidence"].alias("confidence"), "n")


def _re2(pattern: str) -> str:
    return pattern.replace("(?<![A-Za-z0-9_])", r"\b").replace("(?![A-Za-z0-9_])", r"\b").replace("'", "''")


_RULES = ", ".join(f"({i}, '{t}', '{c}', '{_re2(p)}', {s})" for i, (t, c, p, s) in enumerate(employment.TITLE_RULES))
#: A title with full-width and mathematical letters and digits and no-break spaces in their plain form.
_COMPOSED = """nfc_normalize(array_to_string(list_transform(string_split(title, ''), lambda c: CASE WHEN unicode(c) BETWEEN 65281 AND 65374 THEN chr(unicode(c) - 65248)
  WHEN unicode(c) IN (160, 8199, 8239, 12288) OR unicode(c) BETWEEN 8192 AND 8202 THEN ' '
  WHEN unicode(c) BETWEEN 119808 AND 120483 THEN chr((unicode(c) - 119808) % 52 + CASE WHEN (unicode(c) - 119808) % 52 < 26 THEN 65 ELSE 71 END)
  WHEN unicode(c) BETWEEN 120782 AND 120831 THEN chr((unicode(c) - 120782) % 10 + 48) ELSE c END), ''))"""
_RANKS = ", ".join(f"('{t}', {r})" for t, r in employment.RANK.items())


@query(rf"""
WITH r(i, t, c, p, strip) AS (VALUES {_RULES}), k(t, rank) AS (VALUES {_RANKS}),
j AS (SELECT title, count(*) AS n, {_COMPOSED} AS plain FROM source_jobs WHERE title IS NOT NULL GROUP BY 1),
e AS (SELECT title, n, i, t, c FROM j JOIN r ON regexp_matches(CASE WHEN strip THEN regexp_replace(plain, '{_re2(employment.ADMINISTRATION)}', ' ', 'g') ELSE plain END, p)),
s AS (SELECT title, n, count(*) FILTER (c = 'high') AS firm, arg_min(t, (c <> 'high')::INT * 100 + i) FILTER (t IN ('internship', 'co_op', 'apprenticeship')) AS fam,
  arg_min(c, (c <> 'high')::INT * 100 + i) FILTER (t IN ('internship', 'co_op', 'apprenticeship')) AS famc,
  bool_or(c = 'high' AND t = 'full_time') AND bool_or(c = 'high' AND t = 'part_time') AS clash FROM e GROUP BY ALL),
w AS (SELECT e.title, arg_min(e.t, -k.rank * 100 + e.i) AS t FROM e JOIN s USING (title) JOIN k ON k.t = e.t WHERE e.c = 'high' OR s.firm = 0 GROUP BY 1)
SELECT j.title, CASE WHEN s.title IS NULL THEN NULL WHEN fam IS NOT NULL THEN fam WHEN clash THEN NULL ELSE w.t END AS job_type,
 CASE WHEN s.title IS NULL THEN NULL WHEN fam IS NOT NULL THEN famc WHEN clash THEN NULL WHEN firm > 0 THEN 'high' ELSE 'medium' END AS confidence,
 coalesce(fam IS NULL AND clash, false) AS conflict, j.n FROM j LEFT JOIN s USING (title) LEFT JOIN w USING (title)""")
def title_employment(spark: SparkSession, folder: str) -> DataFrame:
    """The employment type that each distinct title states; titles are looked at once."""
    titles = _jobs(spark, folder).where("title is not null").groupBy("title").agg(F.count("*").alias("n"))
    found = employment.resolve(employment.title_evidence(F.col("title")))
    return titles.select("title", found["type"].alias("job_type"), found["confidence"].alias("confidence"), found["conflict"].alias("conflict"), "n")


@query()
def posting_employment(spark: SparkSession, folder: str) -> DataFrame:
    """All evidence of every posting and its resolved type."""
    jobs = _jobs(spark, folder)
    kind = classify.kind(F.col("title"), F.col("structured_job_type"))
    found = employment.employment(F.col("title"), F.col("description"), F.col("structured_job_type"), kind)
    return jobs.select("job_id", found.alias("e")).select("job_id", "e.type", "e.confidence", "e.conflict", F.size("e.items").alias("n_items"))


@query(r"""
SELECT doc_id, left(regexp_replace(replace(coalesce(text, ''), chr(0), ''), '[\x01-\x08\x0B\x0C\x0E-\x1F]', ' ', 'g'), 200) AS head, strlen(coalesce(text, '')) AS n_bytes FROM documents""")
def clean_and_cut(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.cut(text.clean(F.col("text")), 200).alias("head"), F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))


_TAG_SQL = "|".join(text.TAGS)
_PAGE = "concat('<div class=\"x\"><h2>A &amp;amp; B</h2><script>no()</script><!-- no --><p>', replace(text, chr(10), '<br/>'), '</p> &lt;T&gt; &quot;q&quot;<ul><li>one</li></ul></div>')"


@query(rf"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 concat('<div class="x"><h2>A &amp;amp; B</h2><script>no()</script><!-- no --><p>', replace(text, chr(10), '<br/>'), '</p> &lt;T&gt; &quot;q&quot;<ul><li>one</li></ul></div>'),
 '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?i)<\s*(?:br\b[^>]*|/(?:p|div|li|h[1-6]))\s*/?>', chr(10), 'g'),
 '(?i)</?(?:{_TAG_SQL})\b[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t]+', ' ', 'g'), '\n\s*\n\s*\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS body
FROM documents WHERE text IS NOT NULL""")
def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every document wrapped in markup and brought back to text."""
    docs = table(spark, folder, "documents").where("text is not null")
    page = F.concat(
        F.lit('<div class="x"><h2>A &amp;amp; B</h2><script>no()</script><!-- no --><p>'), F.replace(F.col("text"), F.lit("\n"), F.lit("<br/>")),
        F.lit('</p> &lt;T&gt; &quot;q&quot;<ul><li>one</li></ul></div>'),
    )
    return docs.select("doc_id", text.plain_text(page).alias("body"))


_SCHEMES = ["https://", "http://", "ftp://", "https://user@", "", "HTTPS://"]


@query(rf"""
SELECT ok, count(*) AS n FROM (SELECT coalesce(regexp_matches(u, '^(?i)https?://[^/@\s]+(?:[/?#].*)?$'), false) AS ok FROM
  (SELECT CASE WHEN url IS NULL THEN NULL ELSE {_sql_list(_SCHEMES)}[job_id % 6 + 1] || regexp_replace(url, '^https://', '') END AS u FROM source_jobs)) GROUP BY ok""")
def url_validity(spark: SparkSession, folder: str) -> DataFrame:
    jobs = _jobs(spark, folder).select(F.concat(_pick("job_id", _SCHEMES), F.regexp_replace("url", "^https://", "")).alias("u"))
    return jobs.groupBy(text.safe_url(F.col("u")).alias("ok")).agg(F.count("*").alias("n"))


@query(r"""
SELECT raw_id, CASE WHEN v > 1e12 THEN CAST(v AS BIGINT) * 1000 WHEN v > 0 THEN CAST(floor(v) AS BIGINT) * 1000000 END AS instant_us,
 CASE WHEN v IS NOT NULL AND v > 0 THEN 'timestamp' ELSE 'unknown' END AS epoch_precision,
 regexp_matches(coalesce(trim(posted_at), ''), '^\d{4}-\d{2}-\d{2}(?:T00:00(?::00(?:\.0+)?)?)?$') AS is_day
FROM (SELECT raw_id, posted_at, CASE WHEN regexp_matches(posted_at, '^\d{9,13}(?:\.\d+)?$') THEN try_cast(posted_at AS DOUBLE) END AS v FROM raw_postings)""")
def epoch_instants(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_postings").select("raw_id", "posted_at", F.when(F.col("posted_at").rlike(r"^\d{9,13}(?:\.\d+)?$"), F.col("posted_at").cast("double")).alias("v"))
    instant = temporal.epoch_instant(F.col("v"))
    return raw.select(
        "raw_id", F.unix_micros(instant).alias("instant_us"), F.when(F.col("v") > 0, temporal.posted_precision(F.col("posted_at"), instant)).otherwise("unknown").alias("epoch_precision"),
        (F.coalesce(temporal.posted_precision(F.col("posted_at"), F.lit(0)) == "date", F.lit(False))).alias("is_day"),
    )


@query("""SELECT event_id, '{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS canonical, sha256('{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}') AS hash FROM events""")
def canonical_hash(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    json = hashing.canonical_json(F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "a": "'), F.col("event_type"), F.lit('"}')))
    return events.select("event_id", json.alias("canonical"), F.sha2(json, 256).alias("hash"))


@query("""
SELECT i.job_id, CASE WHEN s.job_id IS NULL THEN 'new' WHEN i.h IS NOT DISTINCT FROM s.h THEN 'unchanged' ELSE 'updated' END AS change
FROM (SELECT job_id, source_content_sha256 AS h FROM source_jobs) i LEFT JOIN
 (SELECT job_id, CASE WHEN job_id % 7 = 1 THEN 'old' ELSE source_content_sha256 END AS h FROM source_jobs WHERE job_id % 7 <> 0) s USING (job_id)""")
def change_only(spark: SparkSession, folder: str) -> DataFrame:
    """Postings against a stored state in which some are missing and some hold another hash."""
    jobs = _jobs(spark, folder).select("job_id", F.col("source_content_sha256").alias("h"))
    stored = jobs.where("job_id % 7 <> 0").withColumn("h", F.when(F.col("job_id") % 7 == 1, "old").otherwise(F.col("h")))
    return corpus.change_only(jobs, stored, ["job_id"], "h").select("job_id", "change")


_NOW = "2026-05-01 00:00:00"


@query(f"""SELECT job_id FROM source_jobs WHERE epoch_us(greatest(coalesce(last_seen_at, TIMESTAMPTZ '1970-01-01 00:00:00+00'), coalesce(updated_at, TIMESTAMPTZ '1970-01-01 00:00:00+00')))
 <= epoch_us(TIMESTAMP '{_NOW}') - 21600000000""")
def presence_restamp(spark: SparkSession, folder: str) -> DataFrame:
    jobs = _jobs(spark, folder).select("job_id", "last_seen_at", "updated_at")
    return corpus.restamp(jobs, ["last_seen_at", "updated_at"], F.to_timestamp(F.lit(_NOW))).select("job_id")


@query(r"""
WITH p AS (SELECT board_id, snapshot_no, row_number() OVER (PARTITION BY board_id ORDER BY snapshot_no) AS n FROM snapshot_passes WHERE is_complete),
s AS (SELECT DISTINCT board_id, p.n, trim(uid, E' \t\n\r') AS uid FROM snapshot_rows JOIN p USING (board_id, snapshot_no) WHERE trim(uid, E' \t\n\r') <> ''),
g AS (SELECT k.board_id, k.uid, p.n, p.snapshot_no, s.uid IS NOT NULL AS here FROM (SELECT board_id, uid, min(n) AS f FROM s GROUP BY ALL) k JOIN p ON p.board_id = k.board_id AND p.n >= k.f
  LEFT JOIN s ON s.board_id = k.board_id AND s.uid = k.uid AND s.n = p.n),
l AS (SELECT *, lag(here) OVER w AS h1, lag(here, 2) OVER w AS h2 FROM g WINDOW w AS (PARTITION BY board_id, uid ORDER BY n)),
e AS (SELECT board_id, snapshot_no, uid, CASE WHEN here AND h1 IS NULL THEN 'new' WHEN here AND NOT h1 AND NOT h2 THEN 'reopened' WHEN NOT here AND h1 THEN 'first_miss'
  WHEN NOT here AND NOT h1 AND h2 THEN 'closed' END AS event FROM l)
SELECT * FROM e WHERE event IS NOT NULL""")
def two_miss_closure(spark: SparkSession, folder: str) -> DataFrame:
    passes = table(spark, folder, "snapshot_passes").where("is_complete")
    rows = table(spark, folder, "snapshot_rows").select("board_id", "snapshot_no", F.expr(r"nullif(trim(BOTH ' \t\n\r' FROM uid), '')").alias("uid")).where("uid is not null")
    return corpus.closure(rows, passes, board="board_id", sequence="snapshot_no", key="uid")


@query(r"""
SELECT board_id, n_rows, n_malformed, n_duplicate, n_declared, CASE WHEN n_rows > 50000 THEN 'TOO_MANY_JOBS' WHEN n_malformed = n_rows OR n_malformed > greatest(5, floor(n_rows * 0.1)) THEN 'MALFORMED_JOB'
 WHEN n_duplicate > 0 THEN 'DUPLICATE_JOB_ID' WHEN n_declared <> n_rows THEN 'INCOMPLETE_BOARD' ELSE 'ok' END AS verdict FROM (
 SELECT board_id, count(*) AS n_rows, count(*) FILTER (bad) AS n_malformed, count(uid) FILTER (NOT bad) - count(DISTINCT uid) FILTER (NOT bad) AS n_duplicate, max(page_no) AS n_declared
 FROM (SELECT *, locations IS NULL OR trim(locations) = '' AS bad FROM raw_postings) GROUP BY board_id)""")
def board_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """Boards of the raw records, a record without locations being malformed and the last page number the declared total."""
    raw = table(spark, folder, "raw_postings").select("board_id", "uid", "page_no", F.when(F.coalesce(F.trim("locations"), F.lit("")) == "", "MALFORMED_JOB").alias("error"))
    return corpus.board_verdicts(raw, "board_id", "uid", "error", declared="page_no")


@query("""
SELECT board_id, uid, arg_min(job_id, job_id) AS job_id, arg_min(title, job_id) AS title, array_to_string(list_sort(list_distinct(flatten(list(coalesce(locations, []))))), '|') AS locations
FROM source_jobs GROUP BY board_id, uid""")
def merge_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Second deliveries put together with the first: its fields, all locations."""
    merged = corpus.merge_by_key(_jobs(spark, folder), ["board_id", "uid"], ["job_id"], "locations", ["job_id", "title"])
    return merged.withColumn("locations", F.array_join("locations", "|"))


@query("""
SELECT raw_id, CAST(sum(strlen(coalesce(locations, ''))) OVER (PARTITION BY board_id ORDER BY raw_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bytes_so_far,
 sum(strlen(coalesce(locations, ''))) OVER (PARTITION BY board_id ORDER BY raw_id ROWS UNBOUNDED PRECEDING) <= 2000 AS fits FROM raw_postings""")
def running_bytes(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_postings").select("raw_id", "board_id", "locations")
    return corpus.within_bytes(raw, "board_id", ["raw_id"], "locations", 2000).select("raw_id", "bytes_so_far", "fits")


@query("""
SELECT raw_id, first_value(posted_at IGNORE NULLS) OVER (PARTITION BY board_id, uid ORDER BY received_at, raw_id ROWS UNBOUNDED PRECEDING) AS kept_posted_at FROM raw_postings""")
def posted_at_kept(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_postings").select("raw_id", "board_id", "uid", "received_at", "posted_at")
    return corpus.carried_forward(raw, ["board_id", "uid"], ["received_at", "raw_id"], "posted_at", "kept_posted_at").select("raw_id", "kept_posted_at")


def _polls(spark: SparkSession, folder: str) -> DataFrame:
    passes = table(spark, folder, "snapshot_passes")
    return passes.select("board_id", "source_checked_at", (F.col("skipped_malformed") > 0).alias("changed"), (~F.col("is_complete")).alias("failed"))


def _schedule(spark: SparkSession, folder: str) -> DataFrame:
    return scheduling.schedule_after_polls(_polls(spark, folder), "board_id", "source_checked_at", "changed", "failed")


_FOLD = """
WITH RECURSIVE p AS (SELECT board_id, source_checked_at AS t, coalesce(skipped_malformed > 0, false) AS c, coalesce(NOT is_complete, false) AS f,
  row_number() OVER (PARTITION BY board_id ORDER BY source_checked_at, coalesce(skipped_malformed > 0, false), coalesce(NOT is_complete, false)) AS n FROM snapshot_passes WHERE board_id IS NOT NULL AND source_checked_at IS NOT NULL),
s AS (SELECT board_id, CAST(0 AS BIGINT) AS n, CAST(1200 AS INTEGER) AS i, CAST(0.0 AS DOUBLE) AS r, CAST(0 AS INTEGER) AS k, CAST(NULL AS TIMESTAMPTZ) AS t FROM (SELECT DISTINCT board_id FROM p)
 UNION ALL SELECT s.board_id, p.n, CAST(CASE WHEN p.f THEN least(86400, 1200 * pow(2, least(greatest(s.k + 1, 1), 8))) WHEN p.c THEN 1200 ELSE least(3600, ceil(s.i * 1.5)) END AS INTEGER),
 CAST(CASE WHEN p.f THEN s.r ELSE floor((0.2::DOUBLE * p.c::INT + 0.8::DOUBLE * s.r) * 10000 + 0.5) / 10000 END AS DOUBLE), CAST(CASE WHEN p.f THEN s.k + 1 ELSE 0 END AS INTEGER), p.t FROM s JOIN p ON p.board_id = s.board_id AND p.n = s.n + 1),
f AS (SELECT board_id, max(n) AS n FROM s GROUP BY 1), z AS (SELECT s.* FROM s JOIN f USING (board_id, n) WHERE n > 0)
"""


@query(_FOLD + "SELECT board_id, i AS poll_interval_seconds, r AS change_rate_ema, k AS consecutive_failures, epoch_us(t) + i::BIGINT * 1000000 AS next_due_us FROM z")
def poll_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return _schedule(spark, folder).withColumn("next_due_us", F.unix_micros("next_due_at")).drop("next_due_at")


_CLAIM_NOW = "2026-05-10 00:00:00"


@query(_FOLD + f""", d AS (SELECT z.board_id, b.ats, b.tier, z.r, (epoch_us(TIMESTAMP '{_CLAIM_NOW}') - epoch_us(z.t)) - z.i::BIGINT * 1000000 AS over FROM z JOIN boards b USING (board_id)),
q AS (SELECT *, row_number() OVER (PARTITION BY ats ORDER BY (over > 7200000000) DESC, (tier = 'hot') DESC, r DESC, over DESC, board_id) AS turn FROM d WHERE over >= 0)
SELECT board_id, ats, CAST(turn AS INTEGER) AS turn FROM q ORDER BY turn, ats, board_id LIMIT 200""")
def claim_due_boards(spark: SparkSession, folder: str) -> DataFrame:
    """The next 200 boards, fair across sources (a top-k)."""
    boards = table(spark, folder, "boards").select("board_id", "ats", "tier")
    due = sized_join(_schedule(spark, folder), boards, ["board_id"], "inner")
    claimed = scheduling.claim_due(
        due, source="ats", due="next_due_at", now=F.to_timestamp(F.lit(_CLAIM_NOW)), proven=F.col("tier") == "hot", rate=F.col("change_rate_ema"), key="board_id", limit=200
    )
    return claimed.select("board_id", "ats", "turn")


@query(_FOLD + f""", d AS (SELECT z.board_id, b.ats, b.tier, z.r, (epoch_us(TIMESTAMP '{_CLAIM_NOW}') - epoch_us(z.t)) - z.i::BIGINT * 1000000 AS over FROM z JOIN boards b USING (board_id)),
q AS (SELECT *, row_number() OVER (PARTITION BY ats ORDER BY (over > 7200000000) DESC, (tier = 'hot') DESC, r DESC, over DESC, board_id) AS turn FROM d WHERE over >= 0),
c AS (SELECT board_id, row_number() OVER (ORDER BY turn, ats, board_id) - 1 AS n FROM q QUALIFY n < 200)
SELECT board_id, CAST(n // 64 AS INTEGER) AS batch_no, CAST(least(64, 200 - (n // 64) * 64) AS INTEGER) AS batch_limit FROM c""")
def claim_batches(spark: SparkSession, folder: str) -> DataFrame:
    return scheduling.claim_batches(claim_due_boards(spark, folder), ["turn", "ats", "board_id"], cap=200, batch=64).select("board_id", "batch_no", "batch_limit")


@query("""
SELECT shard, count(*) AS n_boards FROM boards JOIN (VALUES ('greenhouse', ['greenhouse']), ('lever', ['lever']), ('ashby', ['ashby']),
 ('others', ['recruitee', 'workable', 'breezy', 'pinpoint', 'teamtailor', 'usajobs'])) s(shard, l) ON list_contains(l, ats) GROUP BY shard""")
def shard_boards(spark: SparkSession, folder: str) -> DataFrame:
    shards = F.explode(F.array(*[F.lit(s) for s in ("greenhouse", "lever", "ashby", "others")])).alias("shard")
    counts = table(spark, folder, "boards").groupBy("ats").agg(F.count("*").alias("n")).select("ats", "n", shards)
    covered = counts.where(F.col("ats").isin(adapters.SOURCES) & scheduling.in_shard(F.col("ats"), F.col("shard")))
    return covered.groupBy("shard").agg(F.sum("n").alias("n_boards"))


@query("""
SELECT user_id % 9 AS source_no, count(*) FILTER (event_type = 'signup') AS n_signup, count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) FILTER (event_type = 'error') AS n_error
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20' GROUP BY 1""")
def event_pivot(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where("ts between timestamp_ntz '2024-01-03' and timestamp_ntz '2024-01-20'")
    return metrics.event_counts(events.withColumn("source_no", F.col("user_id") % 9), "source_no", "event_type", ["signup", "purchase", "error"])


@query("""
SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE coalesce(source, 'unknown') END AS source, count(*) AS n_postings, count(description) AS n_described, count(structured_job_type) AS n_typed,
 count(*) FILTER (len(country_codes) > 0) AS n_with_country, CAST(CASE WHEN count(description) > 0 THEN floor(sum(length(description)) / count(description) + 0.5) ELSE 0 END AS BIGINT) AS mean_chars
FROM source_jobs GROUP BY ROLLUP (source)""")
def pass_summary(spark: SparkSession, folder: str) -> DataFrame:
    sums = {
        "n_postings": F.count("*"), "n_described": F.count("description"), "n_typed": F.count("structured_job_type"), "n_with_country": F.count_if(F.size("country_codes") > 0),
        "mean_chars": metrics.mean_or_zero(F.sum(F.length("description")), F.count("description")),
    }
    return metrics.with_total(_jobs(spark, folder), "source", sums)


@query("""
SELECT count(*) AS n_boards, CAST(sum(failed) AS BIGINT) AS n_failed, sum(failed) > greatest(3, floor(count(*) * 0.05)) AS failed FROM
 (SELECT board_id, max((NOT is_complete)::INT) AS failed FROM snapshot_passes GROUP BY 1)""")
def pass_verdict(spark: SparkSession, folder: str) -> DataFrame:
    boards = table(spark, folder, "snapshot_passes").groupBy("board_id").agg(F.max((~F.col("is_complete")).cast("int")).alias("f"))
    sums = boards.agg(F.count("*").alias("n_boards"), F.sum("f").alias("n_failed"))
    return sums.withColumn("failed", metrics.pass_failed(F.col("n_boards"), F.col("n_failed")))


@query("""
SELECT coalesce(country, unresolved_reason, 'none') AS outcome, country_method, count(*) AS n FROM (SELECT unnest(CASE WHEN len(countries) > 0 THEN countries ELSE [NULL] END) AS country, country_method, unresolved_reason FROM location_resolutions) GROUP BY ALL""")
def country_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "location_resolutions").select(F.explode_outer("countries").alias("country"), "country_method", "unresolved_reason")
    return rows.groupBy(F.coalesce("country", "unresolved_reason", F.lit("none")).alias("outcome"), "country_method").agg(F.count("*").alias("n"))


@query("""
SELECT status, count(*) AS n_boards, CAST(sum(n) AS BIGINT) AS n_jobs FROM (SELECT b.board_id, CASE WHEN board_url IS NULL THEN 'unknown' WHEN count(j.job_id) > 0 THEN 'active' ELSE 'empty' END AS status, count(j.job_id) AS n
 FROM boards b LEFT JOIN source_jobs j ON j.board_id = b.board_id AND j.is_publicly_listed GROUP BY b.board_id, board_url) GROUP BY 1""")
def registry_status(spark: SparkSession, folder: str) -> DataFrame:
    """The state of every board: jobs are counted before the join, so no board's jobs meet in one task."""
    counts = _jobs(spark, folder).where("is_publicly_listed").groupBy("board_id").agg(F.count("job_id").alias("n"))
    boards = table(spark, folder, "boards").select("board_id", "board_url").join(counts, "board_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("board_url").isNull(), "unknown").when(F.col("n") > 0, "active").otherwise("empty")
    return boards.groupBy(status.alias("status")).agg(F.count("*").alias("n_boards"), F.sum("n").alias("n_jobs"))


@query("SELECT job_id, board_id, uid FROM source_jobs WHERE job_id > 1000 AND is_publicly_listed AND len(country_codes) = 0 ORDER BY job_id LIMIT 1000")
def backfill_page(spark: SparkSession, folder: str) -> DataFrame:
    """One page of the backfill scan: keyset order, resumable cursor (the page size is the feature)."""
    rows = _jobs(spark, folder).where("job_id > 1000 and is_publicly_listed and size(country_codes) = 0")
    return rows.select("job_id", "board_id", "uid").orderBy("job_id").limit(1000)


_LABELS = ["Remote - Worldwide", "Remote (anywhere in the world)", "Worldwide", "Remote", "worldwide remote"]


@query(rf"""
SELECT job_id, regexp_matches(l, '(?i)^(?:remote\s*(?:[-–—|:,/]\s*)?{{s}}|remote\s*\(\s*{{s}}\s*\)|{{s}}\s*(?:[-–—|:,/]\s*)?remote)$') OR (job_id % 2 = 0 AND regexp_matches(l, '(?i)^{{s}}$')) AS worldwide
FROM (SELECT job_id, {_sql_list(_LABELS)}[job_id % 5 + 1] AS l FROM source_jobs)""".replace("{s}", "(?:worldwide|anywhere in the world)"))
def worldwide_remote(spark: SparkSession, folder: str) -> DataFrame:
    """Labels that state worldwide remote work; a bare scope counts only where the record itself is remote."""
    from postloom.operators.locations import states_worldwide

    jobs = _jobs(spark, folder).select("job_id", _pick("job_id", _LABELS).alias("l"))
    return jobs.select("job_id", states_worldwide(F.col("l"), F.col("job_id") % 2 == 0).alias("worldwide"))


def _provider_json(jobs: DataFrame) -> DataFrame:
    """Every posting written in its provider's shape."""
    s = lambda **c: F.to_json(F.struct(*[v.alias(k) for k, v in c.items()]))
    c = F.col
    place = F.coalesce(F.get("locations", F.lit(0)), F.lit(""))
    posted = temporal.iso_text(c("posted_at"))
    objects = lambda name: F.transform("locations", lambda x: F.struct(x.alias(name)))
    st = lambda **k: F.struct(*[v.alias(n) for n, v in k.items()])
    shapes = {
        "greenhouse": s(id=c("uid"), title=c("title"), absolute_url=c("url"), content=c("description"), location=st(name=place), first_published=posted),
        "lever": s(id=c("uid"), text=c("title"), hostedUrl=c("url"), descriptionPlain=c("description"), categories=st(location=place), createdAt=F.unix_millis("posted_at")),
        "ashby": s(id=c("uid"), title=c("title"), jobUrl=c("url"), descriptionPlain=c("description"), location=place, publishedAt=posted),
        "recruitee": s(id=c("uid"), title=c("title"), careers_url=c("url"), description=c("description"), location=place, published_at=posted),
        "workable": s(shortcode=c("uid"), title=c("title"), url=c("url"), description=c("description"), locations=F.array(st(city=place)), published_on=posted),
        "breezy": s(id=c("uid"), name=c("title"), url=c("url"), position_page_description=c("description"), location=st(name=place), published_date=posted),
        "pinpoint": s(id=c("uid"), title=c("title"), url=c("url"), description=c("description"), location=st(name=place), published_at=posted),
        "teamtailor": s(id=c("uid"), title=c("title"), url=c("url"), content_html=c("description"), date_published=posted, _jobposting=st(jobLocation=st(address=st(addressLocality=place)))),
        "usajobs": s(MatchedObjectId=c("uid"), MatchedObjectDescriptor=st(PositionTitle=c("title"), PositionURI=c("url"), PositionLocationDisplay=place, PublicationStartDate=posted,
                     UserArea=st(Details=st(JobSummary=c("description"))))),
    }
    json = None
    for name, shape in shapes.items():
        json = F.when(c("source") == name, shape) if json is None else json.when(c("source") == name, shape)
    return jobs.select("job_id", "source", json.alias("raw_json"))


@query(r"""
SELECT job_id, source, uid, title, url, CASE WHEN source = 'workable' THEN trim(coalesce(locations[1], '')) ELSE coalesce(locations[1], '') END AS place, epoch_ms(posted_at) * 1000 AS posted_us,
 CASE WHEN posted_at IS NULL THEN 'unknown' ELSE 'timestamp' END AS posted_precision,
 CASE WHEN uid IS NULL OR coalesce(trim(title), '') = '' OR url IS NULL OR length(title) > 2000 THEN 'MALFORMED_JOB' END AS error FROM (SELECT * REPLACE (CASE WHEN trim(locations[1]) = '' THEN [''] ELSE locations END AS locations) FROM source_jobs)""")
def provider_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every posting written in its provider's shape and read back by the provider's adapter."""
    made = adapters.normalized(adapters.extract(_provider_json(_jobs(spark, folder))))
    r = F.col("record")
    place = F.coalesce(F.get(r["locations"], F.lit(0)), F.lit(""))
    return made.select("job_id", "source", r["uid"].alias("uid"), r["title"].alias("title"), r["url"].alias("url"), place.alias("place"), F.unix_micros(r["posted_at"]).alias("posted_us"), "posted_precision", "error")


def _label_sql() -> str:
    from postloom.operators import locations as loc

    plain, accents = loc._ACCENTS[1], loc._ACCENTS[0]
    fold = lambda x: rf"trim(regexp_replace(regexp_replace(regexp_replace(translate(lower({x}), '{accents}', '{plain}'), '&', ' and ', 'g'), '[.''’`]', '', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    scopes = ", ".join(f"'{s}'" for s in loc.SCOPES)
    short = ", ".join(f"('{k}', '{v}')" for k, v in loc.SHORT.items())
    words = f"(?:{loc.REMOTE})"
    return rf"""
WITH l AS (SELECT DISTINCT label FROM (SELECT unnest(locations) AS label FROM source_jobs)),
names AS (SELECT {fold('n')} AS norm, 'country' AS kind, code FROM (SELECT unnest([name, lower(iso3_code)] || coalesce(other_names, [])) AS n, country_code AS code FROM countries)
 UNION ALL SELECT w, 'country', c FROM (VALUES {short}) v(w, c)
 UNION ALL SELECT lower(region_code), 'region', country_code FROM places
 UNION ALL SELECT {fold('n')}, 'place', code FROM (SELECT unnest([name, alt_name]) AS n, country_code AS code FROM places)),
dim AS (SELECT norm, list(DISTINCT code) FILTER (kind = 'country') AS country, list(DISTINCT code) FILTER (kind = 'region') AS region, list(DISTINCT code) FILTER (kind = 'place') AS place
 FROM names WHERE norm <> '' AND code IS NOT NULL GROUP BY norm),
u AS (SELECT label, unnest(p) AS unit, generate_subscripts(p, 1) AS unit_no FROM (SELECT label, regexp_split_to_array(coalesce(label, ''), '[;|\n]+|\s*/\s*') AS p FROM l)),
s AS (SELECT label, unit_no, regexp_matches(unit, '{loc.DENIED}') AS denied, unnest(regexp_split_to_array(unit, '[,()（）、:>]+|\s+[-–—]+\s+|\s+(?:or|and|&|\+)\s+')) AS seg FROM u),
w AS (SELECT *, {fold('seg')} AS whole FROM s),
c AS (SELECT *, trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(whole, '^{words}\b(?: (?:in|from|within|across|only|based in|the))*', ''), '\b{words}$', '')),
 '^(?:based in|located in|office in|in|the) ', ''), ' (?:office|offices|hq|campus|site|hub)$|^\d{{3,7}} | \d{{1,7}}$', '', 'g')) AS norm, regexp_matches(whole, '\b{words}\b') AS remote FROM w),
f AS (SELECT c.*, norm IN ({scopes}) OR whole IN ({scopes}) AS scope, country, region, place FROM c LEFT JOIN dim USING (norm)),
t AS (SELECT label, unit_no, bool_or(denied) AS denied, bool_or(remote) AS remote, bool_or(scope) AS scope, bool_or(norm <> '') AS said, list_distinct(flatten(list(coalesce(country, [])))) AS explicit,
 list_distinct(flatten(list(CASE WHEN country IS NULL THEN coalesce(region, []) ELSE [] END))) AS near, list(DISTINCT place) FILTER (country IS NULL AND place IS NOT NULL) AS spots FROM f GROUP BY ALL),
h AS (SELECT *, CASE WHEN len(near) > 0 THEN near ELSE explicit END AS hints FROM t),
k AS (SELECT *, list_transform(coalesce(spots, []), lambda x: CASE WHEN len(hints) > 0 THEN list_intersect(x, hints) ELSE x END) AS kept FROM h),
q AS (SELECT *, len(list_filter(kept, lambda x: len(x) = 0)) > 0 AND NOT denied AS clash0, len(list_filter(kept, lambda x: len(x) > 1)) > 0 AND NOT denied AS open, CASE WHEN denied THEN [] ELSE explicit END AS e FROM k),
r AS (SELECT *, CASE WHEN denied OR clash0 THEN [] ELSE flatten(list_filter(kept, lambda x: len(x) = 1)) END AS read, clash0 AND len(e) = 0 AS clash FROM q),
g AS (SELECT label, list_sort(list_distinct(flatten(list(e || read)))) AS countries, bool_or(len(e) > 0) AS ex, bool_or(len(e) > 0 AND remote) AS er, bool_or(clash) AS conflict, bool_or(open) AS ambiguous, bool_or(remote) AS is_remote,
 bool_or(scope) AS scope, bool_or(said) AS said FROM r GROUP BY label)
SELECT label, array_to_string(countries, '|') AS countries, CASE WHEN len(countries) = 0 THEN NULL WHEN er THEN 'remote-country' WHEN ex THEN 'explicit-label' ELSE 'gazetteer' END AS method, ambiguous, conflict, is_remote,
 CASE WHEN trim(coalesce(label, '')) = '' THEN 'empty' WHEN len(countries) > 0 THEN NULL WHEN scope THEN 'region' WHEN conflict THEN 'conflict' WHEN ambiguous THEN 'ambiguous' WHEN is_remote AND NOT said THEN 'bare-remote' ELSE 'unknown' END AS unresolved_reason
FROM g"""


@query(_label_sql())
def label_countries(spark: SparkSession, folder: str) -> DataFrame:
    """The countries of every distinct location label, whose segments are looked up as a whole."""
    from postloom.operators.locations import resolve_whole_segments

    return _label_countries(spark, folder, resolve_whole_segments)


@query()
def label_countries_inside(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the words inside segments, anchored codes and exclusions; SQL has no left-to-right reading."""
    from postloom.operators.locations import resolve_labels

    return _label_countries(spark, folder, resolve_labels)


def _label_countries(spark: SparkSession, folder: str, resolve) -> DataFrame:
    labels = _jobs(spark, folder).select(F.explode("locations").alias("label"))
    found = resolve(labels, "label", table(spark, folder, "places"), table(spark, folder, "countries"))
    return found.withColumn("countries", F.array_join("countries", "|"))


@query("""
WITH w AS (SELECT DISTINCT v FROM (SELECT unnest(countries) AS v FROM location_resolutions)),
d AS (SELECT lower(unnest([country_code, iso3_code, name])) AS k, country_code AS c FROM countries
 UNION ALL SELECT k, c FROM (VALUES ('united states of america', 'US'), ('great britain', 'GB'), ('uk', 'GB'), ('kanada', 'CA'), ('日本', 'JP'), ('états-unis', 'US'), ('kenya', 'KE'), ('ghana', 'GH'), ('estonia', 'EE'), ('uruguay', 'UY'), ('vietnam', 'VN')) x(k, c))
SELECT v AS written, min(c) AS country_code FROM w LEFT JOIN d ON d.k = lower(trim(v)) GROUP BY v""")
def structured_country(spark: SparkSession, folder: str) -> DataFrame:
    """The country that each distinct written value states by code or name."""
    from postloom.functions.countries import structured_country as stated

    values = table(spark, folder, "location_resolutions").select(F.explode("countries").alias("written")).distinct()
    return stated(values, "written")


@query("""
SELECT b.board_id, CASE WHEN j.n IS NULL AND b.verify_status <> 'unknown' AND b.board_id % 5 <> 0 THEN 'empty' WHEN b.board_id % 5 <> 0 AND j.n > 0 THEN 'active' ELSE b.verify_status END AS verify_status
FROM boards b LEFT JOIN (SELECT board_id, count(*) AS n FROM source_jobs GROUP BY 1) j USING (board_id)""")
def status_update(spark: SparkSession, folder: str) -> DataFrame:
    """The registry after a verification whose unknown outcomes (every fifth board) change nothing."""
    from postloom.operators.state import conditional_update

    boards = table(spark, folder, "boards").select("board_id", "verify_status")
    counts = _jobs(spark, folder).groupBy("board_id").agg(F.count("*").alias("n"))
    probed = boards.join(counts, "board_id", "left").select(
        "board_id", F.when((F.col("board_id") % 5 == 0) | (F.col("n").isNull() & (F.col("verify_status") == "unknown")), "unknown").when(F.col("n") > 0, "active").otherwise("empty").alias("verify_status")
    )
    return conditional_update(boards, probed, ["board_id"], ["verify_status"], unless="unknown")


#: Titles and descriptions as written, their types worked out by hand in the SQL of the query.
_STATEMENTS = [
    ("Cook", "Employment type: Full-time"),
    ("Cook", "Job Type: Contract"),
    ("Cook", "Time Type: Part time"),
    ("Cook", "This is a full-time position"),
    ("Cook", "This role is a 6-month contract"),
    ("Cook", "This is a full-time contract position"),
    ("Cook", "This is a full-time role. This is a contract job."),
    ("Cook", "a full-time position and part-time hours"),
    ("Cook", "雇用形態：正社員"),
    ("Cook", "Type de contrat : CDI"),
    ("Part-time cook", "Employment type: Full-time"),
    ("Ｉｎｔｅｒｎ", "Employment type: Full-time"),
    ("Cook", "Ｅｍｐｌｏｙｍｅｎｔ ｔｙｐｅ： Ｆｕｌｌ－ｔｉｍｅ"),
    ("Cook", "This is a part-time degree program"),
]


@query("""
SELECT job_id, job_type, confidence, conflict FROM source_jobs JOIN (VALUES
 (0, 'full_time', 'high', false), (1, 'contract', 'high', false), (2, 'part_time', 'high', false), (3, 'full_time', 'high', false), (4, 'contract', 'high', false),
 (5, 'contract', 'high', false), (6, 'contract', 'high', false), (7, 'part_time', 'medium', false), (8, 'full_time', 'high', false), (9, 'full_time', 'medium', false),
 (10, NULL, NULL, true), (11, 'internship', 'high', false), (12, 'full_time', 'high', false), (13, NULL, NULL, false)) v(i, job_type, confidence, conflict) ON i = job_id % 14""")
def employment_resolve(spark: SparkSession, folder: str) -> DataFrame:
    """Statements of titles and descriptions, one for every posting by its id, and the type they resolve to."""
    jobs = _jobs(spark, folder).select("job_id", _pick("job_id", [t for t, _ in _STATEMENTS]).alias("t"), _pick("job_id", [d for _, d in _STATEMENTS]).alias("d"))
    found = employment.employment(F.col("t"), F.col("d"), F.lit(None).cast("string"), F.lit("other"))
    return jobs.select("job_id", found.alias("e")).select("job_id", F.col("e.type").alias("job_type"), "e.confidence", "e.conflict")


_PLACES_SAID = ["Germany", "Deutschland", "Remote - US", "United Kingdom", "EMEA", "Caribbean", "Remote", "Nowhere Land", "", "Remote (Germany)", "Multiple Locations", "teletrabajo"]


@query("""
SELECT job_id, countries, unresolved_reason FROM source_jobs JOIN (VALUES
 (0, 'DE', NULL), (1, 'DE', NULL), (2, 'US', NULL), (3, 'GB', NULL), (4, '', 'region'), (5, '', 'region'), (6, '', 'bare-remote'), (7, '', 'unknown'), (8, '', 'empty'),
 (9, 'DE', NULL), (10, '', 'region'), (11, '', 'bare-remote')) v(i, countries, unresolved_reason) ON i = job_id % 12""")
def resolve_location(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as written, one for every posting by its id, and the countries they state or the reason why none."""
    from postloom.operators.locations import resolve_labels

    jobs = _jobs(spark, folder).select("job_id", _pick("job_id", _PLACES_SAID).alias("label"))
    told = resolve_labels(jobs, "label", table(spark, folder, "places"), table(spark, folder, "countries"))
    told = told.select("label", F.array_join(F.array_sort("countries"), ",").alias("countries"), "unresolved_reason")
    return sized_join(jobs, told, ["label"], "inner", spread_by="job_id").select("job_id", "countries", "unresolved_reason")
