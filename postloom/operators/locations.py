"""Countries of location labels: explicit names, a gazetteer with disambiguation, scopes and reasons.

Labels are looked at once however often they occur. Each label is cut into units, segments and runs of words by expressions; the
runs are looked up in dimensions built from the reference tables (countries and places), and what they hit is read per label.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.joins import sized_join

#: Words for working from elsewhere, on folded words, with what stands before and behind them.
REMOTE = (
    "(?:fully |100 |full |partially |mostly )?(?:remote|remoto|remota|teletrabajo|teletravail|hybrid|hibrido|home ?based|home ?office|work from home|wfh|telecommute"
    "|telework|virtual|distributed|on ?site|in ?office|office ?based|flexible)(?: (?:work|working|role|roles|position|job|jobs|eligible|friendly|first|ok|okay|possible"
    "|available|option|optional|only|allowed))?"
)
#: Words that deny.
DENIED = r"(?i)\b(?:not|except|excluding|excluded|outside|sauf|hors)\b|以外|除外|対象外|除く|不包括|不含"
#: Labels that name a region, continent or scope and no country.
SCOPES = [
    "emea", "apac", "apj", "latam", "lat am", "amer", "amers", "namer", "na", "eu", "europe", "european union",
    "eu uk", "uk eu", "asia", "asia pacific", "asia pac", "asiapac", "africa", "americas", "north america", "south america",
    "latin america", "central america", "caribbean", "middle east", "mena", "menat", "gcc", "nordics", "nordic",
    "scandinavia", "benelux", "dach", "cee", "cis", "anz", "oceania", "australasia", "eastern europe", "western europe",
    "southern europe", "northern europe", "central europe", "southeast asia", "south east asia", "south asia", "east asia",
    "sub saharan africa", "west africa", "east africa", "north africa", "southern africa", "global", "worldwide",
    "world wide", "international", "anywhere", "anywhere in the world", "multiple locations", "multiple", "various",
    "various locations", "other", "tbd", "tbc", "location tbd", "to be determined", "n a", "none", "unknown",
    "flexible", "distributed", "us timezones", "us time zones", "est", "pst", "cst", "mst", "cet", "gmt", "utc",
    "east coast", "west coast", "midwest", "southeast", "northeast", "southwest", "northwest", "pacific", "atlantic",
    "select locations", "all locations", "any", "any location", "open", "everywhere", "home", "field", "travel",
    "traveling", "travelling", "nationwide", "national", "regional", "onsite", "on site", "hybrid", "remote",
]
#: Short labels that mean a country only as a whole segment.
SHORT = {"us": "US", "usa": "US", "uk": "GB", "gb": "GB", "gbr": "GB", "can": "CA", "au": "AU", "aus": "AU", "sg": "SG", "sgp": "SG", "jp": "JP", "jpn": "JP"}
#: Further words that deny, and the words that deny the country behind or before them; the last two on folded words.
ALSO_DENIED = r"(?i)\bexclu(?:e|s|es)?\b|बाहर"
DENIED_BEHIND = "(?:^| )(?:not(?: (?:in|within|from|available in))?|except|excluding|outside(?: of)?|sauf|hors(?: (?:de|du|des))?)(?: the)?$"
DENIED_BEFORE = "^(?:(?:is |are )?(?:excluded|not (?:included|eligible|available)|exclu(?:e|s|es)?)(?: |$)|以外|除外|対象外|を?除く|क ब हर)"
#: Region codes that are also words or well-known abbreviations; they count only beside a place or country.
GUARDED = "de me or it hi ok no id il as be in on co ne oh md mb nb pe yt sa act ms mt ma al".split()
#: Countries all of whose region codes are guarded; guarded codes that count behind an unlisted town; what looks like one.
GUARDED_LANDS = {"IN"}
SHAPE_SAFE = "or hi ok oh on mb nb act".split()
_TOWN = r"^(?!(?:[Rr]emote|[Hh]ybrid|[Oo]n-?[Ss]ite|[Vv]irtual|[Aa]nywhere|[Ff]lexible|[Hh]ome|[Ww][Ff][Hh])\b)\p{Lu}[\p{L}'’.]*(?:[\s-]\p{L}[\p{L}'’.]*){0,3}$"
_CJK = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー"
_ACCENTS = ("àáâãäåāăąçćčďèéêëēęěìíîïīłñńňòóôõöøōőŕřśşšťùúûüūůűýÿźżžœæßđ", "aaaaaaaaacccdeeeeeeeiiiiilnnnoooooooorrssstuuuuuuuyyzzzoasd")


def folded_segment(text: Column) -> Column:
    """Lower case without accents; ampersands as ``and``; other punctuation as single spaces."""
    low = F.translate(F.lower(text), *_ACCENTS)
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "&", " and "), "[.'’`]", ""), r"[^\p{L}\p{N}]+", " "))


def states_worldwide(label: Column, is_remote: Column) -> Column:
    """Whether a whole label states worldwide remote work; a bare scope counts only with ``is_remote``."""
    scope = "(?:worldwide|anywhere in the world)"
    squeezed = F.trim(F.regexp_replace(label, r"\s+", " "))
    both = squeezed.rlike(rf"(?i)^(?:remote\s*(?:[-–—|:,/]\s*)?{scope}|remote\s*\(\s*{scope}\s*\)|{scope}\s*(?:[-–—|:,/]\s*)?remote)$")
    return both | (is_remote & squeezed.rlike(f"(?i)^{scope}$"))


def location_dimension(places: DataFrame, countries: DataFrame) -> DataFrame:
    """(``norm``, ``kind``, ``codes``): country names and short labels, region codes and place names with the countries they may mean.

    The kind ``iso`` holds two-letter country codes: a region code that is one of them may mean that country too.
    """
    names = F.concat(F.array("name", F.lower("iso3_code")), F.coalesce("other_names", F.array().cast("array<string>")))
    lands = countries.select(F.explode(names).alias("n"), F.col("country_code").alias("code")).select(folded_segment(F.col("n")).alias("norm"), F.lit("country").alias("kind"), "code")
    spark = places.sparkSession
    short = spark.createDataFrame(list(SHORT.items()), "norm string, code string").select("norm", F.lit("country").alias("kind"), "code")
    regions = places.select(F.lower("region_code").alias("norm"), F.lit("region").alias("kind"), F.col("country_code").alias("code"))
    spots = places.select(F.explode(F.array("name", "alt_name")).alias("n"), F.col("country_code").alias("code")).select(folded_segment(F.col("n")).alias("norm"), F.lit("place").alias("kind"), "code")
    iso = countries.select(F.lower("country_code").alias("norm"), F.lit("iso").alias("kind"), F.col("country_code").alias("code"))
    every = lands.unionByName(iso).unionByName(short).unionByName(regions).unionByName(spots).where("norm <> '' and code is not null")
    return every.groupBy("norm", "kind").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def _runs(whole: Column, core: Column, denied: Column, most: int) -> Column:
    """The runs of words of a segment to be looked up: ARRAY<STRUCT<how, at, len, norm, gone>>.

    ``how`` is ``core`` (the whole segment without its frame; always one), ``words`` (up to ``most`` words), ``prefix`` (a CJK word
    without its ward or city ending) or ``out`` (a CJK word without its denial). ``gone``: a denial stands right before or behind.
    """
    words = F.split(whole, " ")

    def run(how, at, length, norm, gone):
        return F.struct(F.lit(how).alias("how"), at.cast("int").alias("at"), length.cast("int").alias("len"), norm.alias("norm"), gone.alias("gone"))

    def gone(at, length):
        first = F.greatest(at - 4, F.lit(0))
        behind = F.array_join(F.slice(words, first + 1, at - first), " ").rlike(DENIED_BEHIND)
        return denied & (behind | F.array_join(F.slice(words, at + length + 1, 3), " ").rlike(DENIED_BEFORE))

    def at_word(word, at):
        lengths = F.sequence(F.lit(1), F.least(F.lit(most), F.size(words) - at))
        size = F.length(word)
        cuts = F.filter(F.sequence(F.greatest(size - 9, F.lit(1)), size - 1), lambda n: F.substring(word, n + 1, size).rlike(f"^[{_CJK}]{{0,8}}[区市町村郡]$"))
        none = F.array().cast("array<struct<how:string,at:int,len:int,norm:string,gone:boolean>>")
        inner = F.regexp_replace(word, "(?:以外|除外|対象外|を?除く)$|^(?:不包括|不含)", "")
        return F.concat(
            F.transform(lengths, lambda n: run("words", at, n, F.array_join(F.slice(words, at + 1, n), " "), gone(at, n))),
            F.when(word.rlike("[区市町村郡]$") & (size > 1), F.transform(cuts, lambda n: run("prefix", at, F.lit(1), F.substring(word, F.lit(1), n), F.lit(False)))).otherwise(none),
            F.when(inner != word, F.array(run("out", at, F.lit(1), inner, F.lit(True)))).otherwise(none),
        )

    return F.concat(F.array(run("core", F.lit(0), F.size(words), core, F.lit(False))), F.flatten(F.transform(words, at_word)))


class _Item:
    """Something read in a segment: an explicit country, a place name or a region code, and the countries it may mean."""

    def __init__(self, kind: str, codes: list[str], at: int, anchored: bool = True, quiet: bool = False):
        self.kind, self.candidates, self.at, self.anchored, self.quiet = kind, set(codes), at, anchored, quiet
        self.resolved: set[str] = set()
        self.shape_safe = False

    @property
    def ambiguous(self) -> bool:
        return len(self.candidates) != 1


def _code_item(hit: dict, at: int, upper: bool, before: _Item | None) -> _Item:
    word, iso = hit["norm"] in GUARDED, hit["iso"] or []
    item = _Item("code", [*hit["region"], *iso], at, upper and not word and not iso and not GUARDED_LANDS & set(hit["region"]), word and not iso)
    item.shape_safe = upper and hit["how"] == "core" and hit["len"] == 1 and hit["norm"] in SHAPE_SAFE and len(item.candidates) == 1 and not iso
    if not item.anchored and before is not None and before.kind == "explicit" and len(both := before.candidates & set(hit["region"])) == 1:
        item.anchored, item.candidates = True, both
    return item


def _segment_items(hits: list[dict], at: int) -> list[_Item]:
    """The items of a segment: what it is as a whole, else from left to right explicit countries, the longest place name, a CJK
    prefix or a region code. Short country labels and codes inside a segment count in upper case only."""
    core = next(h for h in hits if h["how"] == "core")
    upper = set(core["upper"])
    if core["country"]:
        return [_Item("explicit", core["country"], at)]
    if core["place"]:
        return [_Item("name", core["place"], at)]
    if core["region"]:
        return [_code_item(core, at, core["norm"] in upper, None)]
    runs = {(h["at"], h["len"]): h for h in hits if h["how"] == "words"}
    codes = {h["at"] for h in runs.values() if h["len"] == 1 and h["region"] and h["norm"] in upper}
    items: list[_Item] = []
    i = 0
    for start in sorted({h["at"] for h in hits if h["how"] != "core"}):
        if start < i:
            continue
        here = sorted((h for h in hits if h["how"] in ("words", "prefix") and h["at"] == start), key=lambda h: (h["how"] == "words", h["len"], len(h["norm"])), reverse=True)
        short = lambda h: re.fullmatch("[a-z]{1,3}", h["norm"]) is not None
        beside = core["len"] <= 2 and all(p in codes for p in range(core["len"]) if p != start)
        named = next((h for h in here if h["how"] == "words" and h["country"] and (not short(h) or (h["norm"] in upper and beside))), None)
        place = next((h for h in here if h["place"]), None)
        code = runs.get((start, 1))
        if named:
            items.append(_Item("explicit", named["country"], at))
        elif place:
            items.append(_Item("name", place["place"], at))
        elif code and start in codes:
            items.append(_code_item(code, at, True, items[-1] if items else None))
        i = start + ((named or place or {"len": 1})["len"])
    return items


def _settle(group: list[_Item], unit: list[_Item]) -> bool:
    """Resolves the items of one location; true when two different countries are anchored in it."""
    for k, item in enumerate(group):
        if item.kind != "code":
            continue
        before = group[k - 1] if k else None
        stated = next((x for x in unit if x.kind == "explicit" and abs(x.at - item.at) <= 1), None)
        beside = before if before and before.kind == "name" and before.at >= item.at - 1 else stated
        if beside and (supported := item.candidates & beside.candidates):
            item.anchored = item.anchored or len(supported) == 1
            item.candidates = supported
    anchors = [x for x in group if x.anchored and not x.ambiguous]
    lands = set().union(*(x.candidates for x in anchors))
    for item in anchors:
        item.resolved = item.candidates
    rest = [x for x in group if x.ambiguous or not x.anchored]
    if len(lands) == 1:
        for item in rest:
            if (item.kind != "code" or item.anchored) and lands <= item.candidates:
                item.resolved = lands
    elif not lands:
        mutual = [x for x in rest if x.kind != "code" or x.anchored or x.ambiguous]
        if len(mutual) >= 2 and len(common := set.intersection(*(x.candidates for x in mutual))) == 1:
            for item in mutual:
                item.resolved = common
    return len(lands) > 1


def _read_label(runs: list[dict]) -> dict:
    units: dict[int, dict[tuple, list[dict]]] = {}
    for run in runs:
        units.setdefault(run["unit_no"], {}).setdefault((run["a"], run["b"], run["c"]), []).append(run)
    told = {"e": False, "er": False, "conflict": False, "ambiguous": False, "is_remote": False, "scope": False, "said": False}
    lands: set[str] = set()
    excluded: set[str] = set()
    stated: list[tuple[set[str], bool]] = []
    for segments in units.values():
        items: list[_Item] = []
        groups: list[list[_Item]] = []
        shape: list[tuple[bool, list[_Item]]] = []
        explicit: set[str] = set()
        remote = False
        for at, place in enumerate(sorted(segments)):
            hits = segments[place]
            core = next(h for h in hits if h["how"] == "core")
            remote |= core["remote"]
            told["scope"] |= core["scope"]
            told["said"] |= core["norm"] != ""
            excluded |= {c for h in hits if h["gone"] and (h["how"] == "out" or not re.fullmatch("[a-z]{1,3}", h["norm"]) or h["norm"] in core["upper"]) for c in h["country"] or []}
            if core["denied_here"]:
                continue
            read = _segment_items(hits, at)
            if not core["denied"]:
                explicit |= {c for x in read if x.kind == "explicit" for c in x.candidates}
            if core["filled"]:
                shape.append((core["town"], read))
            if not read:
                continue
            if not groups or any(x.kind == "name" for x in read):
                groups.append([])
            groups[-1].extend(read)
            items.extend(read)
        told["is_remote"] |= remote
        clash = any([_settle(group, items) for group in groups])
        if len(shape) == 2 and shape[0][0] and not shape[0][1] and len(shape[1][1]) == 1 and (code := shape[1][1][0]).shape_safe and not code.anchored and not code.resolved:
            code.resolved = code.candidates
        told["ambiguous"] |= any(x.kind != "explicit" and x.ambiguous and not x.resolved and not x.quiet for x in items)
        told["conflict"] |= clash and not explicit
        stated.append((explicit, remote))
        if not clash:
            lands |= {c for x in items if x.kind != "explicit" for c in x.resolved}
    for explicit, remote in stated:
        kept = explicit - excluded
        lands |= kept
        told["e"] |= bool(kept)
        told["er"] |= bool(kept) and remote
    return {"countries": sorted(lands - excluded), **told}


def resolve_labels(labels: DataFrame, label: str, places: DataFrame, countries: DataFrame) -> DataFrame:
    """(``label``, ``countries``, ``method``, ``ambiguous``, ``conflict``, ``is_remote``, ``unresolved_reason``) of every distinct label.

    Per unit (cut at ``;``, ``|``, ``/`` and line breaks) and segment: a segment that is an entry as a whole is that entry; any
    other is read from left to right: explicit country names, the longest place name, a CJK place before a ward or city ending,
    region codes in upper case. A place opens a location, what follows up to the next place belongs to it. A code that is a word
    or also a country counts only beside a place or country, some words also behind an unlisted town (``Town, OR``). Names and codes with one meaning decide for the open ones of
    their location, without any the one country that all of them share does; two countries in one location are a conflict.
    An explicit country wins over a conflict. A denied segment contributes nothing, and a country denied by name is taken from
    the whole label. The tables mark no place as a mere anchor, so no such reading is settled. ``method`` is ``explicit-label``,
    ``remote-country`` or ``gazetteer``; the reasons are ``empty``, ``region``, ``conflict``, ``ambiguous``, ``bare-remote`` and ``unknown``.

    Null and blank labels are ``empty``. Labels of any length and repeated labels are fine; extra columns are ignored. The
    dimension is broadcast only when its counted rows fit, else the runs of words are shuffled; the hits are shuffled by label.
    """
    import pyarrow as pa

    distinct = labels.select(F.col(label).alias("label")).distinct()
    units = distinct.select("label", F.posexplode(F.split(F.coalesce("label", F.lit("")), r"[;|\n]+|\s*/\s*")).alias("unit_no", "unit"))
    denies = lambda c: F.col(c).rlike(DENIED) | F.col(c).rlike(ALSO_DENIED)
    parts = units.select("label", "unit_no", F.posexplode(F.split("unit", r"[,()（）、]+")).alias("a", "part"))
    parts = parts.select("label", "unit_no", "a", denies("part").alias("denied"), F.posexplode(F.split("part", r"[:>]+|\s+[-–—]+\s+")).alias("b", "piece"))
    segments = parts.select("label", "unit_no", "a", "b", "denied", denies("piece").alias("denied_here"), F.posexplode(F.split("piece", r"\s+(?:or|and|&|\+)\s+")).alias("c", "segment"))
    norm, core, remote = _framed(F.col("segment"))
    upper = F.transform(F.regexp_extract_all(F.regexp_replace("segment", r"\.", ""), F.lit(r"(?<![\p{L}\p{N}])([A-Z]{2,3})(?![\p{L}\p{N}])"), 1), F.lower)
    town = F.trim("segment")
    place = ["label", "unit_no", "a", "b", "c", "denied", "denied_here"]
    segments = segments.select(*place, norm.alias("whole"), core.alias("core"), remote.alias("remote"), upper.alias("upper"), town.rlike(_TOWN).alias("town"), (town != "").alias("filled"))
    segments = segments.withColumn("scope", F.col("core").isin(SCOPES) | (F.col("whole").isin(SCOPES) & (F.col("core") != "")))
    pairs = location_dimension(places, countries)
    wide = pairs.groupBy("norm").agg(*[F.first(F.when(F.col("kind") == k, F.col("codes")), ignorenulls=True).alias(k) for k in ("country", "region", "place", "iso")])
    most = wide.agg(F.max(F.size(F.split("norm", " ")))).first()[0] or 1
    facts = [*place, "remote", "scope", "upper", "town", "filled"]
    runs = segments.select(*facts, F.explode(_runs(F.col("whole"), F.col("core"), F.col("denied"), most)).alias("run"))
    found = sized_join(runs.select(*facts, "run.*"), wide, ["norm"], "left", spread_by="label")
    found = found.where("how = 'core' or country is not null or region is not null or place is not null")
    gathered = found.groupBy("label").agg(F.collect_list(F.struct(*[c for c in found.columns if c != "label"])).alias("runs"))
    flags = ("e", "er", "conflict", "ambiguous", "is_remote", "scope", "said")
    schema = pa.schema([("label", pa.string()), ("countries", pa.list_(pa.string())), *[(f, pa.bool_()) for f in flags]])

    def read(batches):
        for batch in batches:
            rows = [{"label": r["label"], **_read_label(r["runs"])} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    told = gathered.mapInArrow(read, "label string, countries array<string>, " + ", ".join(f"{f} boolean" for f in flags))
    return _reasoned(told)


def resolve_whole_segments(labels: DataFrame, label: str, places: DataFrame, countries: DataFrame) -> DataFrame:
    """The columns of :func:`resolve_labels`, of every distinct label, where a segment counts only as a whole.

    Per unit (cut at ``;``, ``|``, ``/`` and line breaks): explicit country names stand as they are. A place means the countries of
    its name, narrowed by the region codes beside it, without any by the explicit countries; several left make the place ambiguous,
    none a conflict. An explicit country wins over a conflict. A denied unit contributes nothing. Words inside a segment are not
    read: ``alpha germany`` is ``unknown``.

    Null and blank labels are ``empty``. Labels of any length and repeated labels are fine; extra columns are ignored. The
    dimension is broadcast only when its counted rows fit, else the segments are shuffled.
    """
    distinct = labels.select(F.col(label).alias("label")).distinct()
    units = distinct.select("label", F.posexplode(F.split(F.coalesce("label", F.lit("")), r"[;|\n]+|\s*/\s*")).alias("unit_no", "unit"))
    units = units.withColumn("denied", F.col("unit").rlike(DENIED))
    segments = units.select("label", "unit_no", "denied", F.explode(F.split("unit", r"[,()（）、:>]+|\s+[-–—]+\s+|\s+(?:or|and|&|\+)\s+")).alias("segment"))
    whole, core, remote = _framed(F.col("segment"))
    segments = segments.select("label", "unit_no", "denied", whole.alias("whole"), core.alias("norm"), remote.alias("remote"))
    segments = segments.withColumn("scope", F.col("norm").isin(SCOPES) | F.col("whole").isin(SCOPES))
    pairs = location_dimension(places, countries)
    wide = pairs.groupBy("norm").agg(*[F.first(F.when(F.col("kind") == k, F.col("codes")), ignorenulls=True).alias(k) for k in ("country", "region", "place")])
    found = sized_join(segments, wide, ["norm"], "left", spread_by="label")
    nothing = F.array().cast("array<string>")
    unnamed = F.col("country").isNull()
    by_unit = found.groupBy("label", "unit_no").agg(
        F.bool_or("denied").alias("denied"), F.bool_or("remote").alias("remote"), F.bool_or("scope").alias("scope"), F.bool_or(F.col("norm") != "").alias("said"),
        F.array_distinct(F.flatten(F.collect_list("country"))).alias("explicit"), F.array_distinct(F.flatten(F.collect_list(F.when(unnamed, F.col("region"))))).alias("near"),
        F.collect_set(F.when(unnamed, F.col("place"))).alias("spots"),
    )
    by_unit = by_unit.withColumn("hints", F.when(F.size("near") > 0, F.col("near")).otherwise(F.col("explicit")))
    by_unit = by_unit.withColumn("kept", F.transform("spots", lambda s: F.when(F.size("hints") > 0, F.array_intersect(s, F.col("hints"))).otherwise(s)))
    clash = ~F.col("denied") & F.exists("kept", lambda s: F.size(s) == 0)
    by_unit = by_unit.select(
        "label", "remote", "scope", "said", clash.alias("clash"), (~F.col("denied") & F.exists("kept", lambda s: F.size(s) > 1)).alias("open"),
        F.when(F.col("denied"), nothing).otherwise(F.col("explicit")).alias("explicit"),
        F.when(F.col("denied") | clash, nothing).otherwise(F.flatten(F.filter("kept", lambda s: F.size(s) == 1))).alias("read"),
    )
    stated = F.size("explicit") > 0
    told = by_unit.groupBy("label").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat("explicit", "read"))))).alias("countries"), F.bool_or(stated).alias("e"), F.bool_or(stated & F.col("remote")).alias("er"),
        F.bool_or(F.col("clash") & ~stated).alias("conflict"), F.bool_or("open").alias("ambiguous"), F.bool_or("remote").alias("is_remote"), F.bool_or("scope").alias("scope"), F.bool_or("said").alias("said"),
    )
    return _reasoned(told)


def _framed(segment: Column) -> tuple[Column, Column, Column]:
    """A folded segment, its core without words for remote work and offices, and whether it states remote work."""
    norm = folded_segment(segment)
    words = rf"(?:{REMOTE})"
    core = F.trim(F.regexp_replace(F.regexp_replace(norm, rf"^{words}\b(?: (?:in|from|within|across|only|based in|the))*", ""), rf"\b{words}$", ""))
    core = F.trim(F.regexp_replace(F.regexp_replace(core, "^(?:based in|located in|office in|in|the) ", ""), r" (?:office|offices|hq|campus|site|hub)$|^\d{3,7} | \d{1,7}$", ""))
    return norm, core, norm.rlike(rf"\b{words}\b")


def _reasoned(told: DataFrame) -> DataFrame:
    """Labels with what was read in them, their method and the reason why none was found."""
    has = F.size("countries") > 0
    method = F.when(has & F.col("er"), "remote-country").when(has & F.col("e"), "explicit-label").when(has, "gazetteer")
    reason = (
        F.when(F.coalesce(F.trim("label"), F.lit("")) == "", "empty").when(has, None).when(F.col("scope"), "region").when(F.col("conflict"), "conflict").when(F.col("ambiguous"), "ambiguous")
        .when(F.col("is_remote") & ~F.col("said"), "bare-remote").otherwise("unknown")
    )
    return told.select("label", "countries", method.alias("method"), "ambiguous", "conflict", "is_remote", reason.alias("unresolved_reason"))
