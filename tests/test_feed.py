"""The feed-processing operators: worked examples and edge cases."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from postloom.functions import classify, employment, hashing, text
from postloom.operators import corpus, metrics, scheduling
from postloom.operators.locations import resolve_labels
from postloom.plans import reference_queries
from postloom.sources import adapters
from postloom.sources.boards import board_url, description_block, unexpected_paging, with_pages


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first().y


def test_intervals_of_the_policy(spark):
    def interval(i, f, c, x):
        return spark.range(1).select(scheduling.next_interval(F.lit(i), F.lit(f), F.lit(c), F.lit(x)).alias("y")).first().y

    quiet, seen = 1200, []
    for _ in range(9):
        quiet = interval(quiet, 0, False, False)
        seen.append(quiet)
    assert seen == [1800, 2700, 3600] + [3600] * 6
    assert [interval(3600, 0, True, False), interval(1800, 0, True, False)] == [1200, 1200]
    assert [interval(1200, f, False, True) for f in (0, 1, 2, 3, 4, 5, 6, 7, 8, 40)] == [2400, 2400, 4800, 9600, 19200, 38400, 76800, 86400, 86400, 86400]


def test_change_rate(spark):
    def rate(r, c, x):
        return spark.range(1).select(scheduling.next_change_rate(F.lit(r), F.lit(c), F.lit(x)).alias("y")).first().y

    assert [rate(0.0, True, False), rate(0.2, True, False), rate(0.36, False, False), rate(0.0, False, False), rate(0.288, False, True)] == [0.2, 0.36, 0.288, 0.0, 0.288]


def test_shards_and_claims(spark):
    every = adapters.SOURCES
    sources = spark.createDataFrame([(s, i) for i, s in enumerate(every)], "source string, i int")

    def chosen(condition):
        return [r.source for r in sources.where(condition).orderBy("i").collect()]

    shard = lambda s: chosen(scheduling.in_shard(F.col("source"), F.lit(s).cast("string")))
    claim = lambda s, only, c: chosen(scheduling.claimable(F.col("source"), F.lit(s).cast("string"), F.lit(only).cast("string"), F.lit(c)))
    assert shard("others") == every[3:]
    assert shard("lever, ashby ,nosuch") == ["lever", "ashby"]
    assert shard(None) == shard("all") == every
    assert claim("others", None, False) == every[3:8]
    assert claim("greenhouse", "lever", True) == [] and claim(None, "lever", True) == ["lever"]
    runs = spark.createDataFrame([("123", "2", "lever"), ("123", None, "all"), (" ", None, None)], "r string, a string, s string")
    assert [x[0] for x in runs.select(scheduling.run_key(F.col("r"), F.col("a"), F.col("s"), F.lit("u"))).collect()] == ["123-2-lever", "123-1", "u"]


def test_claim_batches(spark):
    claims = spark.range(150)
    got = scheduling.claim_batches(claims, ["id"], cap=100, batch=64).groupBy("batch_no", "batch_limit").count().collect()
    assert sorted(map(tuple, got)) == [(0, 64, 64), (1, 36, 36)]


@pytest.mark.parametrize(
    "title, structured, want",
    [("Intern, Data", None, "intern"), ("Internal Auditor", None, "other"), ("Engineer", "internship", "intern"), ("New Grad Engineer", None, "new_grad"), ("éintern", None, "intern"), (None, None, "other")],
)
def test_kind(spark, title, structured, want):
    frame = spark.createDataFrame([(title, structured)], "t string, s string")
    assert frame.select(classify.kind(F.col("t"), F.col("s")).alias("y")).first().y == want


def test_terms_and_sponsorship(spark):
    assert one(spark, "SUMMER '26, fall 2027 and Summer 2026", classify.season_terms) == ["Summer 2026", "Fall 2027"]
    assert one(spark, None, classify.season_terms) == []
    assert one(spark, "We will sponsor. U.S. citizenship required", classify.sponsorship) == "citizenship_required"
    assert one(spark, "will sponsor" + "x" * 9000, classify.sponsorship) == "unknown"
    assert one(spark, None, classify.sponsorship) == "unknown"


@pytest.mark.parametrize(
    "written, want",
    [
        ("Employment type: Full-time", "full_time"), ("Job Type: Contract", "contract"), ("Time Type: Part time", "part_time"), ("This is a full-time position", "full_time"),
        ("This role is a 6-month contract", "contract"), ("this is a full-time contract position", "contract"), ("雇用形態：正社員", "full_time"), ("Type de contrat : CDI", "full_time"),
        ("This is a full-time role. This is a contract job.", "contract"), ("a full-time position and part-time hours", "part_time"), ("Ｅｍｐｌｏｙｍｅｎｔ ｔｙｐｅ： Ｆｕｌｌ－ｔｉｍｅ", "full_time"),
        ("full-time basis as a student; seasonal job", None), ("students welcome, and far away from that: a seasonal job", "temporary"), ("This role is a full-time\ninternship", "internship"),
        ("This is a part-time degree program", None), ("nothing here", None), ("", None), (None, None),
    ],
)
def test_description_employment(spark, written, want):
    assert one(spark, written, lambda x: employment.resolve(employment.description_evidence(x))["type"]) == want


def test_employment_conflict_and_implied(spark):
    frame = spark.createDataFrame([("Part-time cook", "Employment type: Full-time", None), ("Cook", "word " * 60, None), ("Cook Intern", "x", "full_time"), (None, None, None)], "t string, d string, s string")
    got = frame.select(employment.employment(F.col("t"), F.col("d"), F.col("s"), F.lit("other")).alias("e")).select("e.type", "e.conflict").collect()
    assert [tuple(r) for r in got] == [(None, True), ("full_time", False), ("internship", False), (None, False)]


def test_labels(spark):
    assert one(spark, "Ｆｕｌｌ－ｔｉｍｅ", lambda x: employment.type_of_label(x)["type"]) == "full_time"
    assert one(spark, "Full-time, Regular", lambda x: employment.type_of_label(x)["type"]) == "full_time"
    assert one(spark, "Contract (12 months)", lambda x: employment.type_of_label(x)["type"]) == "contract"
    assert one(spark, "fixed_term", employment.type_of_code) == "full_time"


def test_plain_text(spark):
    html = "<p>A&amp;B &lt;T&gt; &#x1F600; &#65; &#xD800;</p><script>x</script><!-- c --><ul><li>one</li></ul>"
    assert one(spark, html, text.plain_text) == "A&B <T> 😀 A &#xD800;\n one"
    assert one(spark, "&lt;p&gt;Hi &amp;amp; bye&lt;/p&gt;", text.plain_text) == "Hi & bye"
    assert one(spark, "&amp;lt;", text.decode_entities) == "&lt;"
    assert one(spark, None, text.plain_text) is None and one(spark, "", text.plain_text) == ""
    assert one(spark, "a\0b\x01c\t", text.clean) == "ab c\t" and one(spark, None, text.clean) == ""


@pytest.mark.parametrize("url, ok", [("https://a.b/c", True), ("ftp://a.b", False), ("https://u@a.b", False), ("a.b", False), (None, False)])
def test_safe_url(spark, url, ok):
    assert one(spark, url, text.safe_url) is ok


def test_canonical_json(spark):
    assert one(spark, '{"b": 1, "a": {"d": 2.0, "c": null}}', hashing.canonical_json) == one(spark, '{"a":{"c":null,"d":2},"b":1}', hashing.canonical_json)
    assert one(spark, "no json", hashing.canonical_json) is None


def test_board_addresses():
    assert board_url("greenhouse", "acme") == "https://boards-api.greenhouse.io/v1/boards/acme/jobs?content=true"
    assert board_url("ashby", "flock safety").endswith("/flock%20safety")
    assert "eu.lever" in board_url("lever", "acme", eu=True) and "Organization" not in board_url("usajobs", "all")
    for source, token in (("breezy", "a.b"), ("teamtailor", "localhost"), ("greenhouse", "a/b"), ("nosuch", "a")):
        with pytest.raises(ValueError):
            board_url(source, token)


def test_description_block_by_depth(spark):
    page = '<div class="x description y">a<div>b</div>c</div><div>d</div>'
    assert one(spark, page, description_block) == "a<div>b</div>c"
    assert one(spark, '<div class="description">open', description_block) is None and one(spark, "<p>", description_block) is None
    listed, pages = spark.createDataFrame([("u",), ("v",)], "url string"), spark.createDataFrame([("u", page)], "url string, html string")
    assert {r.url: r.page_description for r in with_pages(listed, pages).collect()} == {"u": "a<div>b</div>c", "v": None}
    assert one(spark, '{"jobs": [], "next": "x"}', unexpected_paging) is True and one(spark, '{"jobs": [], "next": false}', unexpected_paging) is False


def test_adapters_edge_records(spark):
    rows = [
        ("lever", '{"id": 7, "text": "T", "hostedUrl": "https://a.b", "lists": [{"text": "H", "content": "<li>x</li>"}], "descriptionPlain": "D", "categories": {"location": "P", "allLocations": ["P", "Q"]}}'),
        ("workable", '{"shortcode": "s", "title": "T", "url": "https://a.b", "locations": [{"city": "C", "hidden": true}, {"city": "D", "country": "E"}]}'),
        ("teamtailor", '{"id": "1", "title": "T", "url": "https://a.b", "_jobposting": {"jobLocation": {"address": {"addressLocality": "L", "addressCountry": "SE"}}}}'),
        ("usajobs", '{"MatchedObjectId": "9", "MatchedObjectDescriptor": {"PositionTitle": "T", "ApplyURI": ["https://a.b"], "PositionSchedule": [{"Name": "Full-time"}], "PublicationStartDate": "2026-09-08T00:00:00.0000"}}'),
        ("greenhouse", '{"id": 1.5, "title": 5}'),
        ("greenhouse", None),
        ("greenhouse", '{"id": "x", "title": "T", "absolute_url": "ftp://a"}'),
    ]
    got = adapters.normalized(adapters.extract(spark.createDataFrame(rows, "source string, raw_json string"))).collect()
    by = {(r.source, r.record.uid): r for r in got}
    assert by["lever", "7"].record.description == "D\n\nH\nx" and by["lever", "7"].record.locations == ["P", "Q"]
    assert by["workable", "s"].record.locations == ["D, E"] and by["teamtailor", "1"].record.countries == ["SE"]
    usa = by["usajobs", "9"]
    assert (usa.posted_precision, usa.record.posted_at, usa.record.structured_type, usa.record.url) == ("date", datetime(2026, 9, 8), "Full-time", "https://a.b")
    assert by["greenhouse", None].error == "MALFORMED_JOB" and by["greenhouse", "x"].error == "MALFORMED_JOB_URL"
    body = spark.createDataFrame([("recruitee", '{"offers": [{"id": 1}, {"id": 2}]}'), ("lever", "[]"), ("lever", "oops")], "source string, body string")
    assert [(r.pos, r.record_json) for r in adapters.unwrap(body).collect()] == [(0, '{"id":1}'), (1, '{"id":2}')]


def test_verdict_thresholds(spark):
    rows = [(1, f"u{i}", "bad" if i < 5 else None) for i in range(50)] + [(2, f"u{i}", "bad" if i < 6 else None) for i in range(50)] + [(3, "u", None), (3, "u", None), (4, "u", "bad")]
    got = {r.b: r.verdict for r in corpus.board_verdicts(spark.createDataFrame(rows, "b int, u string, e string"), "b", "u", "e").collect()}
    assert got == {1: "ok", 2: "MALFORMED_JOB", 3: "DUPLICATE_JOB_ID", 4: "MALFORMED_JOB"}


def test_running_bytes_of_a_hot_group(spark):
    rows = [(g, i, "x" * (i % 5) if i % 7 else None, 1) for g, n in (("hot", 900), ("b", 30), (None, 20)) for i in range(n)]
    got = corpus.within_bytes(spark.createDataFrame(rows, "g string, i int, t string, fits int"), "g", ["i"], "t", 500).collect()
    sums: dict = {}
    want = {}
    for g, i, t, _ in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        sums[g] = sums.get(g, 0) + len(t or "")
        want[g, i] = (sums[g], sums[g] <= 500)
    assert {(r.g, r.i): (r.bytes_so_far, r.fits) for r in got} == want and len(got) == len(rows)


def test_change_only_nulls_and_replay(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "k int, h string")
    stored = spark.createDataFrame([(1, None), (2, "x")], "k int, h string")
    assert {r.k: r.change for r in corpus.change_only(rows, stored, ["k"], "h").collect()} == {1: "unchanged", 2: "updated", 3: "new"}
    assert {r.change for r in corpus.change_only(rows, rows, ["k"], "h").collect()} == {"unchanged"}


def test_rollup_names(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    got = {r.s: r.n for r in metrics.with_total(rows, "s", {"n": F.sum("n")}).collect()}
    assert got == {"a": 1, "unknown": 2, "all": 3}
    assert metrics.counts_map(rows, "s").first().counts == {"a": 1}


LABELS = [
    ("Alpha", ["DE"], "gazetteer", None), ("Alpha, Germany", ["DE"], "explicit-label", None), ("Remote - US", ["US"], "remote-country", None), ("Twin", [], None, "ambiguous"),
    ("Twin, BY", ["DE"], "gazetteer", None), ("Twin, USA", ["US"], "explicit-label", None), ("Alpha, TX", [], None, "conflict"), ("EMEA", [], None, "region"), ("Remote", [], None, "bare-remote"),
    ("Nowhere", [], None, "unknown"), ("", [], None, "empty"), (None, [], None, "empty"), ("Germany; Alpha / US", ["DE", "US"], "explicit-label", None), ("not in Germany", [], None, "unknown"),
    ("Remote in Deutschland", ["DE"], "remote-country", None), ("x" * 20000, [], None, "unknown"),
]


def test_label_countries(spark):
    places = spark.createDataFrame([("Alpha", None, "BY", "DE"), ("Twin", None, "BY", "DE"), ("Twin", None, "TX", "US")], "name string, alt_name string, region_code string, country_code string")
    countries = spark.createDataFrame([("DE", "DEU", "Germany", ["Deutschland"]), ("US", "USA", "United States", None)], "country_code string, iso3_code string, name string, other_names array<string>")
    frame = spark.createDataFrame([(x[0], 1) for x in LABELS] * 2, "label string, countries int")
    got = {r.label: r for r in resolve_labels(frame, "label", places, countries).collect()}
    assert len(got) == len(LABELS)
    for label, lands, method, reason in LABELS:
        r = got[label]
        assert (r.countries, r.method, r.unresolved_reason) == (lands, method, reason), label[:40] if label else label


WHOLE = [
    ("Alpha, Twin", "DE", "gazetteer", None), ("alpha germany", "", None, "unknown"), ("Twin, BY", "DE", "gazetteer", None), ("Alpha, TX", "", None, "conflict"), ("Alpha, Germany", "DE", "explicit-label", None),
    ("not in Germany", "", None, "unknown"), ("Germany; not in US", "DE", "explicit-label", None), ("Remote - US / Twin", "US", "remote-country", None), ("", "", None, "empty"), (None, "", None, "empty"), ("東京都港区", "", None, "unknown"),
]


def test_label_countries_query_against_its_sql(spark, tmp_path):
    places = [("Alpha", None, "BY", "DE"), ("Twin", None, "BY", "DE"), ("Twin", None, "TX", "US"), ("Tokyo", "東京都", "TK", "JP")]
    spark.createDataFrame(places, "name string, alt_name string, region_code string, country_code string").write.parquet(f"{tmp_path}/places.parquet")
    lands = [("DE", "DEU", "Germany", ["Deutschland"]), ("US", "USA", "United States", None), ("JP", "JPN", "Japan", ["日本"])]
    spark.createDataFrame(lands, "country_code string, iso3_code string, name string, other_names array<string>").write.parquet(f"{tmp_path}/countries.parquet")
    labels = [x[0] for x in WHOLE] + [x[0] for x in LABELS] + [x[0] for x in SCANNED]
    spark.createDataFrame([(i, [x, x]) for i, x in enumerate(labels)], "job_id bigint, locations array<string>").write.parquet(f"{tmp_path}/source_jobs.parquet")
    con = duckdb.connect()
    for name in ("places", "countries", "source_jobs"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = reference_queries.QUERIES["label_countries"](spark, str(tmp_path))
    names = ["label", "countries", "method", "ambiguous", "conflict", "is_remote", "unresolved_reason"]
    want = con.sql(f"SELECT {', '.join(names)} FROM ({reference_queries.ORACLES['label_countries']})").fetchall()
    got = [tuple(r) for r in found.select(names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    told = {r[0]: (r[1], r[2], r[6]) for r in got}
    assert {x[0]: told[x[0]] for x in WHOLE} == {x[0]: x[1:] for x in WHOLE}
    inside = {r.label: r.countries for r in reference_queries.QUERIES["label_countries_inside"](spark, str(tmp_path)).collect()}
    assert (inside["alpha germany"], inside["東京都港区"]) == ("DE", "JP") and len(inside) == len(told)


SCANNED = [
    ("alpha germany", ["DE"], "explicit-label", None), ("Twin Germany", ["DE"], "explicit-label", None), ("Old Alpha Works", ["DE"], "gazetteer", None), ("New Alpha Hills", ["US"], "gazetteer", None),
    ("東京都港区", ["JP"], "gazetteer", None), ("Alpha; Germany (not Twin)", ["DE"], "explicit-label", None), ("Germany, US; not in Germany", ["US"], "explicit-label", None), ("Alpha; outside Germany", [], None, "unknown"),
    ("Nowhere, TX", ["US"], "gazetteer", None), ("Nowhere, OR", ["US"], "gazetteer", None), ("nowhere, OR", [], None, "unknown"), ("Nowhere, KA", [], None, "unknown"), ("Beta, OR", ["US"], "gazetteer", None), ("Beta OR", ["US"], "gazetteer", None), ("US-OR", ["US"], "explicit-label", None),
    ("Twin Beta", ["US"], "gazetteer", None), ("we CAN work", [], None, "unknown"), ("Alpha TX", [], None, "conflict"), ("alpha tx", ["DE"], "gazetteer", None), ("日本以外", [], None, "unknown"),
]


def test_label_countries_inside_segments(spark):
    places = [("Alpha", None, "BY", "DE"), ("Twin", None, "BY", "DE"), ("Twin", None, "TX", "US"), ("Beta", None, "OR", "US"), ("Beta", None, "ON", "CA"), ("New Alpha Hills", None, "TX", "US"), ("Tokyo", "東京都", "TK", "JP"), ("Gamma", None, "KA", "IN")]
    places = spark.createDataFrame(places, "name string, alt_name string, region_code string, country_code string")
    lands = [("DE", "DEU", "Germany", None), ("US", "USA", "United States", None), ("JP", "JPN", "Japan", ["日本"]), ("CA", "CAN", "Canada", None)]
    countries = spark.createDataFrame(lands, "country_code string, iso3_code string, name string, other_names array<string>")
    frame = spark.createDataFrame([(x[0],) for x in SCANNED], "label string")
    got = {r.label: r for r in resolve_labels(frame, "label", places, countries).collect()}
    assert {k: (r.countries, r.method, r.unresolved_reason) for k, r in got.items()} == {x[0]: x[1:] for x in SCANNED}
