"""Timestamps written in many formats and zones, brought to one UTC instant.

Parsing is built-in expressions only. The zone of a local time is found by an as-of join to exploded zone-offset intervals:
two matching intervals mean a repeated hour, none a skipped one, one gives the offset directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.zones import place_in_time, zone_table

#: Month names of the languages written in, by month number; compared without case and accents.
MONTHS = {
    1: "january jan januar janvier janv enero ene januari janeiro stycznia gennaio",
    2: "february feb februar fevrier fevr febrero februari fevereiro lutego febbraio",
    3: "march mar marz maerz mars marzo maart marco marca",
    4: "april apr avril avr abril abr kwietnia aprile",
    5: "may mai mayo maj mei maio maja maggio",
    6: "june jun juni juin junio junho czerwca giugno",
    7: "july jul juli juillet juil julio julho lipca luglio",
    8: "august aug aout agosto ago augusti augustus sierpnia",
    9: "september sep sept septembre septiembre setembro wrzesnia settembre",
    10: "october oct oktober okt octobre octubre outubro pazdziernika ottobre",
    11: "november nov novembre noviembre novembro listopada",
    12: "december dec dezember dez decembre diciembre dic dezembro grudnia dicembre",
}

#: Zone letters and their offset from UTC in minutes; the second list holds those that mean several things and
#: are told apart by the zone they are used in.
LETTERS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "SAST": 120, "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "NST": -210, "NDT": -150, "ADT": -180, "BRT": -180,
    "BRST": -120, "ART": -180, "CLT": -240, "CLST": -180, "COT": -300, "PET": -300, "PKT": 300, "SGT": 480, "HKT": 480,
    "PHT": 480, "MYT": 480, "WIB": 420, "ICT": 420, "JST": 540, "KST": 540, "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600,
    "AEDT": 660, "NZST": 720, "NZDT": 780,
}
LETTERS_BY_ZONE = {
    "IST": [("Europe/", 60), ("Asia/Jerusalem", 120), ("Asia/Tel_Aviv", 120), ("", 330)],
    "BST": [("Asia/", 360), ("", 60)],
    "CST": [("Asia/", 480), ("America/Havana", -300), ("", -360)],
    "AST": [("Asia/", 180), ("", -240)],
    "GST": [("Atlantic/", -120), ("", 240)],
}

_CLOCK = r"(\d{1,2})(?::|\.|[hH]|時)(\d{2})(?:分)?(?:(?::|\.)(\d{2})(?:秒)?(?:[.,](\d{1,9}))?)?"
_HALF = r"(?:\s*([AaPp])\.?[Mm]\.?)?"
_WORDS = r"(?:\s*(?:Uhr|uhr|Std\.?|h|Hrs|hrs))?"
_ZONE = r"(?:\s*\(?(Z|z|(?:UTC|GMT)?[+\-−]\d{1,2}(?::?\d{2})?(?:\[[A-Za-z_+\-0-9/]+\])?|\[?[A-Z][A-Za-z_]+/[A-Za-z_+\-0-9/]+\]?|[A-Za-z]{1,5})\)?)?"
_TAIL = f"{_CLOCK}{_HALF}{_WORDS}{_ZONE}"
_WEEKDAY = r"(?:\p{L}{2,12}\.?,?\s+)?"
_NAME = r"(\p{L}{3,12})\.?"
_BETWEEN = r"(?:\s*,\s*|\s+|T|\s+(?:à|at|um|a las|om|kl\.?|as|às|alle)\s+)"

#: pattern, then the groups of year, month, day and of the first of the six groups of the clock (0: none).
_SHAPES = {
    "iso": (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:{_BETWEEN}{_TAIL})?$", 1, 2, 3, 4),
    "compact": (r"^(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2})(\d{2})(\d{2})?()()(?:\s*(Z|z|[+\-]\d{2}:?\d{2}|[A-Z]{3,4}))?)?$", 1, 2, 3, 4),
    "numeric": (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?:{_BETWEEN}{_TAIL})?$", 3, 2, 1, 4),
    "day_name": (rf"^{_WEEKDAY}(\d{{1,2}})(?:\.|st|nd|rd|th|er|º)?\s+(?:de\s+)?{_NAME},?\s+(?:del?\s+)?(\d{{4}})(?:{_BETWEEN}{_TAIL})?$", 3, 2, 1, 4),
    "name_day": (rf"^{_WEEKDAY}{_NAME}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:{_BETWEEN}{_TAIL})?$", 3, 1, 2, 4),
    "cjk": (rf"^(\d{{4}})\s*[年년]\s*(\d{{1,2}})\s*[月월]\s*(\d{{1,2}})\s*[日일]?(?:\s*{_TAIL})?$", 1, 2, 3, 4),
}
_ZONE_NAME = r"([A-Z][A-Za-z_]+/[A-Za-z_+\-0-9/]+)"
_SPACE = "[\\s\\u0085\\u00A0\\u1680\\u2000-\\u200B\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]+"


def _month_number(name: Column) -> Column:
    plain = F.translate(F.lower(name), "àáâäçéèêëíóôûüśź", "aaaaceeeeioouusz")
    table = {word: number for number, words in MONTHS.items() for word in words.split()}
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[plain]


def _text(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _groups(text: Column) -> Column:
    """The shape of a written moment and its groups (year, month, day, hour, minute, second, fraction, half, zone), each pattern applied once."""
    dense = text.rlike(r"^(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])(?:[T ]?\d{4}(?:\d{2})?.*)?$") & ~text.rlike(r"^\d{9,13}$")
    found = None
    for name, (pattern, year, month, day, clock) in _SHAPES.items():
        groups = [year, month, day, *range(clock, clock + 6)]
        made = F.split(F.regexp_replace(text, pattern, name + "".join(f"\u0001${g}" for g in groups)), "\u0001")
        test = dense if name == "compact" else text.rlike(pattern)
        found = F.when(test, made) if found is None else found.when(test, made)
    return F.when(text.rlike("\u0001"), F.lit(None)).otherwise(found)


def _parts(groups: Column, month_first: Column) -> Column:
    """The groups of :func:`_groups` as numbers; null where the pattern of a dense date did not match."""
    name = groups[0]
    at = lambda i: F.nullif(F.get(groups, F.lit(i)), F.lit(""))
    second = F.when(name.isin("day_name", "name_day"), _month_number(at(2))).otherwise(F.expr("try_cast(nullif(_g[2], '') as int)"))
    third = at(3).cast("int")
    swap = (name == "numeric") & month_first
    made = F.struct(
        at(1).cast("int").alias("y"),
        F.when(swap, third).otherwise(second).alias("m"),
        F.when(swap, second).otherwise(third).alias("d"),
        at(4).cast("int").alias("h"),
        at(5).cast("int").alias("mi"),
        F.coalesce(at(6).cast("int"), F.lit(0)).alias("s"),
        F.rpad(F.coalesce(at(7), F.lit("0")), 6, "0").substr(1, 6).cast("int").alias("us"),
        F.upper(at(8)).alias("half"),
        at(9).alias("zone"),
    )
    return F.when(F.size(groups) == 10, made)


def parse_written(text: Column, month_first: Column) -> Column:
    """A written moment as STRUCT<epoch_us, day, local_us, zone>; null for what states no existing moment or day.

    ``epoch_us``: an epoch number (seconds with or without fraction, milli-, micro- or nanoseconds, told by the number of
    digits). ``day``: days since 1970 of a bare date. ``local_us``: microseconds of the local date and time as if it were
    UTC; ``zone``: the offset, zone letters or zone name written behind it, or null. ``month_first`` decides numeric dates
    not led by the year. A wrong calendar day or clock time, relative words and seasons give null.
    """
    bare = F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", "")
    number = F.regexp_extract(bare, r"^(-?\d{9,19})(?:\.\d+)?$", 1)
    size = F.length(F.regexp_replace(number, "-", ""))
    value = F.expr("try_cast(_w as decimal(38, 9))")
    epoch = (
        F.when(size.between(9, 11), value * 1000000)
        .when(size.between(12, 13), value * 1000)
        .when(size.between(15, 16), value)
        .when(size.between(18, 19), value / 1000)
    )
    p = F.col("_p")
    hour = F.when(p["half"].isNull(), p["h"]).when(
        p["h"].between(1, 12), F.pmod(p["h"], F.lit(12)) + F.when(p["half"] == "P", 12).otherwise(0)
    )
    hour = F.when(p["h"].isNotNull(), hour)
    day = F.expr("unix_date(try_to_date(concat_ws('-', lpad(_p.y, 4, '0'), lpad(_p.m, 2, '0'), lpad(_p.d, 2, '0')), 'yyyy-MM-dd'))")
    clock_ok = F.col("_h").between(0, 23) & p["mi"].between(0, 59) & p["s"].between(0, 59)
    local = F.col("_day") * F.lit(86400000000) + ((F.col("_h") * 3600 + p["mi"] * 60 + p["s"]).cast("bigint") * 1000000 + p["us"])
    return {
        "_w": bare,
        "_epoch": F.floor(epoch).cast("bigint"),
        "_g": _groups(F.col("_w")),
        "_p": _parts(F.col("_g"), month_first),
        "_day": day.cast("bigint"),
        "_h": hour,
        "_local": F.when(clock_ok, local),
        "value": value,
    }


def _letters_offset(letters: Column, zone: Column) -> Column:
    simple = F.create_map(*[F.lit(x) for pair in LETTERS.items() for x in pair])[letters]
    for name, cases in LETTERS_BY_ZONE.items():
        choice = F.lit(cases[-1][1])
        for prefix, minutes in reversed(cases[:-1]):
            choice = F.when(zone.startswith(prefix), minutes).otherwise(choice)
        simple = F.when(letters == name, choice).otherwise(simple)
    return simple


def to_utc(
    values: DataFrame,
    *,
    text: str,
    zone: str,
    month_first: str,
    out: str = "utc_us",
    reading: str | None = None,
    zones: list[str] | None = None,
) -> DataFrame:
    """``values`` with ``out``: microseconds since 1970 UTC of the moment or day written in ``text``.

    ``zone`` is the IANA zone of texts that state none (null or unknown: UTC); ``month_first`` a boolean column for numeric
    dates not led by the year (null: day first). A stated offset, zone name or zone letters come before ``zone``; letters with
    several meanings are read as used in ``zone``, unknown letters make the value unreadable. Of a repeated local hour the
    first is meant; a skipped local time moves on by the skip. A bare day is its midnight UTC.

    Zones are known for all years: before the first change by mean local time, in far years by the rules in force last.

    ``reading`` names a column that says how the value was read: ``epoch``, ``day``, ``stated`` (an offset or zone letters),
    ``direct`` (one interval holds the local time), ``repeated`` (two do) or ``skipped`` (none does); null where ``out`` is.

    ``out`` is null for null, empty and unreadable texts, for days and clock times that do not exist. Repeated rows stay,
    extra columns stay whatever their names (a column named ``out`` is replaced), empty tables stay empty. ``zones``
    bounds the zone names of the interval table (default: those that occur, found by one pass over the two columns).

    No shuffle of rows: the interval table is bounded by IANA zone names (about 600) times years and is broadcast.
    """
    spark = values.sparkSession
    steps = parse_written(F.col("_text"), F.coalesce(F.col("_first"), F.lit(False)))
    row = F.struct(*[F.col(f"`{c}`") for c in values.columns if c not in (out, reading)]).alias("_row")
    parsed = values.select(row, F.col(text).alias("_text"), F.col(zone).alias("_zone"), F.col(month_first).alias("_first"))
    parsed = parsed.withColumn("_w", steps["_w"]).withColumn("_epoch", steps["_epoch"]).withColumn("_g", steps["_g"]).withColumn("_p", steps["_p"])
    parsed = parsed.withColumn("_day", steps["_day"]).withColumn("_h", steps["_h"]).withColumn("_local", steps["_local"])
    said = F.col("_p.zone")
    offset = r"^(?:UTC|GMT)?([+\-−])(\d{1,2}):?(\d{2})?"
    minutes = F.regexp_extract(said, offset, 2).cast("int") * 60 + F.coalesce(_text(said, offset, 3).cast("int"), F.lit(0))
    minutes = F.when(F.regexp_extract(said, offset, 1) == "+", minutes).otherwise(-minutes)
    named = F.regexp_extract(said, _ZONE_NAME, 1)
    parsed = parsed.withColumn(
        "_stated",
        F.when(said.rlike(offset), minutes).when(said.isNotNull() & (named == ""), _letters_offset(F.upper(said), F.coalesce(F.col("_zone"), F.lit("")))),
    )
    unread = said.isNotNull() & F.col("_stated").isNull() & (named == "")
    parsed = parsed.withColumn("_unread", F.coalesce(unread, F.lit(False))).withColumn(
        "zone_id", F.when((named != "") & F.col("_stated").isNull(), named).otherwise(F.coalesce(F.col("_zone"), F.lit("UTC")))
    )
    year, behind = place_in_time(F.when(F.col("_day").isNotNull(), F.col("_p.y")))
    parsed = parsed.withColumn("local_year", F.when(F.col("_stated").isNull() & ~F.col("_unread"), year))
    spans = zone_table(spark, zones if zones is not None else _zones_used(values, text, zone))
    second = F.floor(F.col("_local") / 1000000) - behind.cast("bigint") * 86400
    parsed = parsed.withColumn("_second", second)
    # The last interval that begins at or before the local time; with it come its own end and the end of the one before.
    at = (F.col("_second") >= F.col("local_start")) & (F.col("_second") < F.col("until"))
    left, right = parsed.alias("l"), F.broadcast(spans).alias("r")
    same = (F.col("l.zone_id") == F.col("r.zone_id")) & (F.col("l.local_year") == F.col("r.local_year"))
    joined = left.join(right, same & at, "left")
    holding = (F.col("_second") < F.col("local_end")).cast("int") + (F.col("_second") < F.col("before_end")).cast("int")
    seconds = (
        F.when(F.col("_stated").isNotNull(), F.col("_stated") * 60)
        .when(F.col("offset_s").isNull(), 0)
        .when(holding == 2, F.col("before_offset_s"))
        .otherwise(F.col("offset_s"))
    )
    moment = F.when(~F.col("_unread"), F.col("_local") - seconds.cast("bigint") * 1000000)
    instant = F.coalesce(F.col("_epoch"), F.when(F.col("_p.h").isNull(), F.col("_day") * F.lit(86400000000)).otherwise(moment))
    told = F.when(F.col("_epoch").isNotNull(), "epoch").when(F.col("_p.h").isNull(), "day").when(F.col("_stated").isNotNull(), "stated")
    told = told.when(holding == 2, "repeated").when(holding == 0, "skipped").otherwise("direct")
    extra = [F.when(instant.isNotNull(), told).alias(reading)] if reading else []
    return joined.select("_row.*", instant.alias(out), *extra)


def _zones_used(values: DataFrame, text: str, zone: str) -> list[str]:
    """The known zone names in the zone column or within the texts; at most as many as there are IANA names."""
    import zoneinfo

    named = F.regexp_extract(F.col(text), _ZONE_NAME, 1)
    names = values.select(F.explode(F.array(F.coalesce(F.col(zone), F.lit("UTC")), F.coalesce(named, F.lit("")))).alias("n")).where(
        F.col("n").isin(sorted(zoneinfo.available_timezones()))
    )
    return [r.n for r in names.distinct().collect()]
