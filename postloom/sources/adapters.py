"""The nine provider record shapes as projections of a VARIANT column into one canonical record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.temporal import epoch_instant, posted_precision, unzoned_instant
from postloom.functions.text import joined, let, plain_text, safe_url, sections

SOURCES = ["greenhouse", "lever", "ashby", "recruitee", "workable", "breezy", "pinpoint", "teamtailor", "usajobs"]
#: Where each provider's response keeps its records; the others are arrays themselves.
RECORD_PATHS = {
    "greenhouse": "$.jobs", "ashby": "$.jobs", "workable": "$.jobs", "recruitee": "$.offers", "pinpoint": "$.data", "teamtailor": "$.items",
    "usajobs": "$.SearchResult.SearchResultItems",
}


def _at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def text(v: Column, path: str) -> Column:
    """The string at ``path``; null for numbers, objects and all else."""
    at = _at(v, path)
    return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(v, f"$.{path}", "string"))


def label(v: Column, path: str) -> Column:
    """A non-blank string."""
    value = text(v, path)
    return F.when(F.trim(value) != "", value)


def identity(v: Column, path: str) -> Column:
    """A string, or a safe integer as a string."""
    number = F.try_variant_get(v, f"$.{path}", "bigint")
    whole = F.schema_of_variant(_at(v, path)).isin("BIGINT", "INT") & (F.abs(number) <= 9007199254740991)
    return F.coalesce(text(v, path), F.when(whole, number.cast("string")))


def html(v: Column, path: str) -> Column:
    return plain_text(label(v, path))


def moment(v: Column, path: str) -> Column:
    """An instant from a number (epoch) or an ISO text."""
    number = F.when(F.schema_of_variant(_at(v, path)) != "STRING", F.try_variant_get(v, f"$.{path}", "double"))
    return F.coalesce(epoch_instant(number), unzoned_instant(text(v, path)))


def flag(v: Column, path: str) -> Column:
    return F.when(F.schema_of_variant(_at(v, path)) == "BOOLEAN", F.try_variant_get(v, f"$.{path}", "boolean"))


def items(v: Column, path: str) -> Column:
    """The array at ``path``; a single object counts as an array of one; else empty."""
    at = _at(v, path)
    one = F.when(F.schema_of_variant(at).startswith("OBJECT"), F.array(at))
    return F.coalesce(F.try_variant_get(v, f"$.{path}", "array<variant>"), one, F.array().cast("array<variant>"))


def _labels(*values: Column) -> Column:
    return F.array_distinct(F.filter(F.array(*values), lambda x: F.trim(x) != ""))


def _each(array: Column, get) -> Column:
    return F.filter(F.transform(array, get), lambda x: F.trim(x) != "")


_NO_TEXT = lambda: F.lit(None).cast("string")
_NO_TIME = lambda: F.lit(None).cast("timestamp")


def _record(v: Column, **parts: Column) -> Column:
    base = {
        "uid": identity(v, "id"), "title": text(v, "title"), "url": text(v, "url"), "description": _NO_TEXT(), "locations": F.array().cast("array<string>"),
        "countries": F.array().cast("array<string>"), "structured_type": _NO_TEXT(), "posted_raw": _NO_TEXT(), "posted_at": _NO_TIME(), "updated_at": _NO_TIME(),
        "is_remote": F.lit(None).cast("boolean"), "is_publicly_listed": F.lit(True),
    }
    return F.struct(*[c.alias(n) for n, c in {**base, **parts}.items()])


def greenhouse(v: Column) -> Column:
    return _record(
        v, url=text(v, "absolute_url"), description=html(v, "content"), locations=_labels(text(v, "location.name")), posted_raw=text(v, "first_published"),
        posted_at=moment(v, "first_published"), updated_at=moment(v, "updated_at"),
    )


def lever(v: Column) -> Column:
    body = F.coalesce(text(v, "descriptionPlain"), plain_text(text(v, "description")))
    lists = F.transform(items(v, "lists"), lambda i: F.array_join(F.filter(F.array(text(i, "text"), html(i, "content")), lambda x: x != ""), "\n"))
    extra = F.coalesce(text(v, "additionalPlain"), plain_text(text(v, "additional")))
    whole = F.array_join(F.filter(F.concat(F.array(body), lists, F.array(extra)), lambda x: x != ""), "\n\n")
    every = F.filter(F.concat(F.array(text(v, "categories.location")), F.coalesce(F.try_variant_get(v, "$.categories.allLocations", "array<string>"), F.array().cast("array<string>"))), lambda x: F.trim(x) != "")
    return _record(
        v, title=text(v, "text"), url=text(v, "hostedUrl"), description=F.nullif(whole, F.lit("")), locations=F.array_distinct(every),
        countries=_labels(text(v, "country")), structured_type=text(v, "categories.commitment"), posted_raw=F.try_variant_get(v, "$.createdAt", "string"),
        posted_at=moment(v, "createdAt"), updated_at=moment(v, "updatedAt"), is_remote=F.when(F.lower(text(v, "workplaceType")) == "remote", True),
    )


def ashby(v: Column) -> Column:
    second = items(v, "secondaryLocations")
    places = F.array_distinct(F.concat(_labels(text(v, "location")), _each(second, lambda s: text(s, "location"))))
    lands = F.array_distinct(F.concat(_labels(text(v, "address.postalAddress.addressCountry")), _each(second, lambda s: text(s, "address.addressCountry"))))
    return _record(
        v, url=F.coalesce(text(v, "jobUrl"), text(v, "applyUrl")), description=F.coalesce(html(v, "descriptionHtml"), text(v, "descriptionPlain")), locations=places,
        countries=lands, structured_type=text(v, "employmentType"), posted_raw=text(v, "publishedAt"), posted_at=moment(v, "publishedAt"),
        updated_at=moment(v, "updated_at"), is_remote=flag(v, "isRemote"), is_publicly_listed=F.coalesce(flag(v, "isListed"), F.lit(True)),
    )


def recruitee(v: Column) -> Column:
    places = items(v, "locations")
    return _record(
        v, url=F.coalesce(text(v, "careers_url"), text(v, "careers_apply_url")), description=sections((None, html(v, "description")), (None, html(v, "requirements"))),
        locations=F.array_distinct(F.concat(_labels(text(v, "location")), _each(places, lambda p: joined(F.coalesce(text(p, "city"), text(p, "name")), text(p, "country"))))),
        countries=F.array_distinct(F.concat(_labels(text(v, "country_code")), _each(places, lambda p: text(p, "country_code")))),
        structured_type=label(v, "employment_type_code"), posted_raw=text(v, "published_at"), posted_at=moment(v, "published_at"), is_remote=flag(v, "remote"),
    )


def workable(v: Column) -> Column:
    shown = F.filter(items(v, "locations"), lambda p: ~F.coalesce(flag(p, "hidden"), F.lit(False)))
    places = F.when(F.size(shown) > 0, _each(shown, lambda p: joined(text(p, "city"), text(p, "region"), text(p, "country")))).otherwise(
        _labels(joined(text(v, "city"), text(v, "state"), text(v, "country")))
    )
    return _record(
        v, uid=identity(v, "shortcode"), url=F.coalesce(text(v, "url"), text(v, "shortlink"), text(v, "application_url")), description=html(v, "description"), locations=places,
        countries=F.array_distinct(F.concat(_labels(label(v, "country")), _each(shown, lambda p: text(p, "countryCode")))), structured_type=label(v, "employment_type"),
        posted_raw=label(v, "published_on"), posted_at=unzoned_instant(label(v, "published_on")), is_remote=flag(v, "telecommuting"),
    )


def breezy(v: Column) -> Column:
    places = items(v, "locations")
    land = F.coalesce(text(v, "location.country.id"), text(v, "location.country.name"), text(v, "location.country"))
    return _record(
        v, title=text(v, "name"), description=html(v, "position_page_description"), locations=F.array_distinct(F.concat(_labels(text(v, "location.name")), _each(places, lambda p: text(p, "name")))),
        countries=_labels(land), structured_type=F.coalesce(label(v, "type.name"), label(v, "type.id")), posted_raw=text(v, "published_date"), posted_at=moment(v, "published_date"),
        is_remote=flag(v, "location.is_remote"),
    )


def pinpoint(v: Column) -> Column:
    def headed(head: str, body: str) -> Column:
        return F.when(html(v, body) != "", F.concat_ws("\n", label(v, head), html(v, body)))

    parts = [(None, html(v, "description"))] + [(None, headed(f"{n}_header", n)) for n in ("key_responsibilities", "skills_knowledge_expertise", "benefits")]
    return _record(
        v, description=sections(*parts), locations=_labels(text(v, "location.name"), joined(text(v, "location.city"), text(v, "location.province"))),
        countries=_labels(F.coalesce(text(v, "location.country_code"), text(v, "location.country"))), structured_type=F.coalesce(label(v, "employment_type"), label(v, "employment_type_text")),
        posted_raw=label(v, "published_at"), posted_at=unzoned_instant(label(v, "published_at")), is_remote=F.when(F.lower(text(v, "workplace_type")) == "remote", True),
    )


def teamtailor(v: Column) -> Column:
    places = items(v, "_jobposting.jobLocation")
    return _record(
        v, description=F.coalesce(html(v, "content_html"), html(v, "_jobposting.description")), locations=_each(places, lambda p: text(p, "address.addressLocality")),
        countries=_each(places, lambda p: text(p, "address.addressCountry")), structured_type=label(v, "_jobposting.employmentType"),
        posted_raw=F.coalesce(text(v, "date_published"), text(v, "_jobposting.datePosted")), posted_at=F.coalesce(moment(v, "date_published"), moment(v, "_jobposting.datePosted")),
        updated_at=moment(v, "date_modified"), is_remote=F.when(text(v, "_jobposting.jobLocationType") == "TELECOMMUTE", True),
    )


def usajobs(v: Column) -> Column:
    d = "MatchedObjectDescriptor"
    places = items(v, f"{d}.PositionLocation")
    detail = f"{d}.UserArea.Details"
    duties = F.array_join(_each(items(v, f"{detail}.MajorDuties"), lambda x: plain_text(F.try_variant_get(x, "$", "string"))), "\n\n")
    types = F.concat(*[_each(items(v, f"{d}.{n}"), lambda t: label(t, "Name")) for n in ("PositionOfferingType", "PositionSchedule")])
    from postloom.functions.employment import type_of_code

    return _record(
        v, uid=identity(v, "MatchedObjectId"), title=text(v, f"{d}.PositionTitle"), url=F.coalesce(text(v, f"{d}.PositionURI"), text(v, f"{d}.ApplyURI[0]")),
        description=sections(
            (None, html(v, f"{detail}.JobSummary")), ("Duties", duties), ("Requirements", html(v, f"{detail}.Requirements")),
            ("Qualifications", html(v, f"{d}.QualificationSummary")), ("Education", html(v, f"{detail}.Education")), ("How to apply", html(v, f"{detail}.HowToApply")),
        ),
        locations=F.array_distinct(F.concat(_labels(text(v, f"{d}.PositionLocationDisplay")), _each(places, lambda p: text(p, "LocationName")))),
        countries=F.array_distinct(_each(places, lambda p: text(p, "CountryCode"))),
        structured_type=F.coalesce(F.get(F.filter(types, lambda t: type_of_code(t).isNotNull()), F.lit(0)), F.get(types, F.lit(0))),
        posted_raw=text(v, f"{d}.PublicationStartDate"), posted_at=unzoned_instant(text(v, f"{d}.PublicationStartDate")), is_remote=flag(v, f"{detail}.RemoteIndicator"),
    )


ADAPTERS = {f.__name__: f for f in (greenhouse, lever, ashby, recruitee, workable, breezy, pinpoint, teamtailor, usajobs)}


def extract(records: DataFrame, source: str = "source", json: str = "raw_json") -> DataFrame:
    """``records`` with ``record``: the canonical record of the provider's JSON text; null JSON and unknown sources give nulls.

    One scan and one parse; a conditional holds a branch for every provider, so rows pay for the projection of their own only.
    """
    def made(v: Column) -> Column:
        chosen = None
        for name, make in ADAPTERS.items():
            chosen = F.when(F.col(source) == name, make(v)) if chosen is None else chosen.when(F.col(source) == name, make(v))
        return chosen

    # Bound within one expression, so that neither the parsed text nor a field of the record is worked out anew at each use.
    return records.withColumn("record", let(F.try_parse_json(json), made))


def unwrap(responses: DataFrame, source: str = "source", body: str = "body") -> DataFrame:
    """One row per record of each whole response: ``record_json`` and ``pos``; responses that are no JSON give no row."""
    parsed = responses.withColumn("_v", F.try_parse_json(body))
    arrays = F.try_variant_get("_v", "$", "array<variant>")
    for name, path in RECORD_PATHS.items():
        arrays = F.when(F.col(source) == name, F.try_variant_get("_v", path, "array<variant>")).otherwise(arrays)
    return parsed.select(*responses.columns, F.posexplode(arrays).alias("pos", "_r")).withColumn("record_json", F.to_json("_r")).drop("_r")


def normalized(extracted: DataFrame) -> DataFrame:
    """The extracted records with ``issues``, ``posted_precision`` and ``error``: MALFORMED_JOB, MALFORMED_JOB_URL, JOB_TOO_LARGE or null."""
    r = F.col("record")
    missing = r["uid"].isNull() | (F.coalesce(F.trim(r["title"]), F.lit("")) == "") | r["url"].isNull()
    long = (F.length(r["uid"]) > 200) | (F.length(r["title"]) > 2000) | (F.length(r["url"]) > 8192)
    error = (
        F.when(missing | F.coalesce(long, F.lit(False)), "MALFORMED_JOB")
        .when(~safe_url(r["url"]), "MALFORMED_JOB_URL")
        .when(F.octet_length(F.to_json(r)) > 1 << 20, "JOB_TOO_LARGE")
    )
    issues = F.array_compact(
        F.array(
            F.when(F.size(r["locations"]) == 0, "location:empty"),
            F.when(F.coalesce(F.trim(r["description"]), F.lit("")) == "", "description:empty"),
            F.when(r["posted_at"].isNull() & r["posted_raw"].isNotNull(), "posted_at:unreadable"),
        )
    )
    return extracted.withColumn("error", error).withColumn("issues", issues).withColumn("posted_precision", posted_precision(r["posted_raw"], r["posted_at"]))
