"""Freely typed values mapped to the entries of a reference list by a prefix-filter set-similarity join.

Both sides become sets of letter pairs and triples. Tokens are ordered by their rarity over both sides; two sets that reach the
Jaccard threshold must share a token among their rarest ones, so only those prefixes are joined. Length and positional filters
come before the exact Jaccard, which decides: the entry with the greatest one is kept. Close to the threshold, where short keys
lie, an edit check follows.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.lookalikes import Classes, Counts, Rewriter, letter_counts, lookalike_classes, rewriter
from postloom.session import checkpoint_ready

#: Words that say how or where near a place work is done, not which place; stripped from the ends of a segment.
BEFORE = ["remote", "hybrid", "on site", "onsite", "in", "near", "downtown", "greater", "hq", "office", "region de", "grossraum", "the"]
AFTER = ["area", "metro", "campus", "office", "hq", "city centre", "city center", "remote", "hybrid", "on site", "onsite", "only"]
#: Written-out forms of short words at the start of a name.
SHORT = {"st": "saint", "sta": "santa", "ft": "fort", "mt": "mount", "n": "north", "w": "west", "s": "south", "e": "east"}
_FOLD = str.maketrans({"ł": "l", "ø": "o", "ß": "ss", "œ": "oe", "æ": "ae", "đ": "d", "þ": "th", "ð": "d", "&": " and "})
_CUTS = re.compile(r"\s[-–—]\s|[,;/():|]|\s[-–—]$")
_STREET = re.compile(r"^\d+\w*\s.*\b(?:street|road|avenue|lane|drive|strasse|rue|way|quay)\b|^\d+(?:st|nd|rd|th)?\s+floor$")
_POSTAL = re.compile(r"^\s*([A-Za-z]{2})-(?=\d|\w{3})(?:\d{3,6}\s+)?")

#: Token counts are kept for this many hashed tokens, so their table has a fixed size and can be broadcast. Tokens that share
#: a number are told apart by the token itself: any total order is right for the prefixes, rarity only makes them short.
RARITY_BUCKETS = 8192


def folded(text: str, plain: Rewriter) -> str:
    """Consistent form, lower case, without accents; words of letters and digits joined by single spaces."""
    low = plain.text(text).casefold().translate(_FOLD)
    bare = "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))
    return " ".join(re.findall(r"[^\W_]+", unicodedata.normalize("NFC", bare)))


def _ends(words: str) -> str:
    before = re.compile(rf"^(?:{'|'.join(BEFORE)})\s+(?=\S)")
    after = re.compile(rf"(?<=\S)\s+(?:{'|'.join(AFTER)})$")
    while True:
        less = after.sub("", before.sub("", words))
        less = re.sub(r"(?<=\S)\s+\d{3,6}$", "", re.sub(r"^\d{3,6}\s+(?=\S)", "", less))
        if less == words:
            return words
        words = less


def segments(text: str | None, plain: Rewriter) -> list[str]:
    """The folded parts of a typed value without work modes, streets and postal codes, a country prefix as its own part."""
    if text is None:
        return []
    flags = [c for c in text if 0x1F1E6 <= ord(c) <= 0x1F1FF]
    if len(flags) == 2 and len(text.strip()) == 2:
        return ["".join(chr(ord(c) - 0x1F1E6 + ord("a")) for c in flags)]
    clear = plain.text(text)
    parts: list[str] = []
    if prefix := _POSTAL.match(clear):
        parts.append(prefix[1].lower())
        clear = clear[prefix.end() :]
    for piece in _CUTS.split(clear):
        words = folded(piece, plain)
        if words and not _STREET.match(words):
            words = _ends(words)
            head, _, rest = words.partition(" ")
            if rest and head in SHORT:
                words = f"{SHORT[head]} {rest}"
            parts.append(words)
    return list(dict.fromkeys(p.replace(" ", "") for p in parts))


def parts_of(text: Column, counts: Counts, classes: Classes) -> Column:
    """:func:`segments` as a column (array of glued parts), by Arrow batches."""

    @F.pandas_udf("array<string>")
    def cut(values: pd.Series) -> pd.Series:
        plain = rewriter(counts, classes)
        return values.map(lambda v: segments(v, plain))

    return cut(text)


def tokens_of(key: Column) -> Column:
    """The distinct padded letter pairs and letter triples of a key; triples are the rare ones the join lives on."""
    padded = F.concat(F.lit("^"), key, F.lit("$"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(key) + 1), lambda i: F.substring(padded, i, F.lit(2)))
    triples = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.substring(padded, i, F.lit(3)))
    return F.when(F.length(key) > 0, F.array_distinct(F.concat(pairs, triples)))


def similar_keys(left: DataFrame, right: DataFrame, *, threshold: float = 0.5, group: str = "kind", most: int = 10_000) -> DataFrame:
    """Pairs (``group``, ``key``, ``other``, ``jaccard``) of keys whose token sets reach ``threshold`` within a group.

    ``left`` and ``right`` have ``group`` and ``key``; ``right`` is the reference list. Null and empty keys have no pair;
    repeated keys count once. Exact: every pair at or above the threshold is returned, no candidate is capped.

    The join is on rare tokens only. Both sides are shuffled by token; a token with more than ``most`` keys is cut into salted
    parts by the key of the left side. Rows carry keys, not sets: what passes the length and positional filters is made distinct
    and its Jaccard counted once. Only the token counts, a table of fixed size, are broadcast.
    """
    spark = left.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sides = left.select(group, "key", F.lit(0).alias("side")).unionByName(right.select(group, "key", F.lit(1).alias("side")))
    sides = sides.where("key <> ''").distinct()
    exploded = sides.select(group, "key", "side", F.explode(tokens_of(F.col("key"))).alias("token"))
    exploded = exploded.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(RARITY_BUCKETS)))
    rarity = exploded.groupBy("bucket").agg(F.count("*").alias("df"))
    ranked = exploded.join(F.broadcast(rarity), "bucket")
    sets = ranked.groupBy(group, "key", "side").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("r"))
    n = F.size("r")
    prefix = n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1
    heads = sets.select(group, "key", "side", n.alias("n"), F.posexplode(F.slice("r", F.lit(1), prefix)).alias("i", "x"))
    heads = heads.select(group, "key", "side", "n", "i", "x.token", F.ceil(F.col("x.df") / most).cast("int").alias("salts"))
    a = heads.where("side = 0").select(
        group, "token", "key", F.col("n").alias("na"), F.col("i").alias("ia"), F.pmod(F.xxhash64("key"), F.col("salts")).cast("int").alias("salt")
    )
    b = heads.where("side = 1").select(
        group, "token", F.col("key").alias("other"), F.col("n").alias("nb"), F.col("i").alias("ib"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    keys = [group, "token", "salt"]
    joined = a.repartition(parts, *keys).join(b.repartition(parts, *keys), keys)
    least = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("na") + F.col("nb")) - 1e-9)
    within = (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-9) & (
        1 + F.least(F.col("na") - F.col("ia") - 1, F.col("nb") - F.col("ib") - 1) >= least
    )
    pairs = joined.where(within).select(group, "key", "other", "na", "nb").repartition(parts, "key", "other").distinct()
    pairs = pairs.withColumn("_o", F.size(F.array_intersect(tokens_of(F.col("key")), tokens_of(F.col("other")))))
    pairs = pairs.withColumn("jaccard", F.col("_o") / (F.col("na") + F.col("nb") - F.col("_o")))
    return pairs.where(F.col("jaccard") >= threshold - 1e-9).select(group, "key", "other", "jaccard")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether one letter is inserted, dropped or replaced, or two neighbours are exchanged."""
    near = F.levenshtein(a, b)
    same_letters = F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))
    first = F.length(F.regexp_extract(F.concat(a, F.lit("\n"), b), r"^(.*).*\n\1.*$", 1))
    swapped = (
        (F.length(a) == F.length(b))
        & same_letters
        & (near == 2)
        & (F.substring(a, first + 3, F.length(a)) == F.substring(b, first + 3, F.length(b)))
    )
    return (near <= 1) | swapped


def map_values(
    values: DataFrame,
    entries: DataFrame,
    *,
    threshold: float = 0.4,
    sure: float = 0.65,
) -> DataFrame:
    """(``kind``, ``text``, ``ref``, ``jaccard``): the entry that each distinct typed value means; ``ref`` null for none.

    ``values`` has ``kind`` and ``text``; ``entries`` has ``kind``, ``key`` (glued and folded), ``ref``, ``fuzzy`` (whether the key may
    be written inexactly) and ``hints`` (folded strings that tell entries with the same key apart, such as region and country). An
    entry whose ``ref`` is null is known to mean no entry: what is most similar to it names nothing.

    A typed value is cut into parts; a part names the entries of the key with the greatest Jaccard, the other parts are hints. From
    ``sure`` upwards the Jaccard alone decides; between ``threshold`` and ``sure`` keys must also lie one edit apart, as short keys
    do. Entries named by several parts must agree. Of several entries the one is meant for which a part is a hint; several or none
    left means no entry.

    Null and blank values mean no entry. Values are looked at once however often they are repeated; very long texts are cut
    like any other. Empty inputs give no rows. Only distinct values are shuffled.
    """
    distinct = values.select("kind", "text").distinct()
    checkpoint_ready(values.sparkSession)
    counts, classes = letter_counts(distinct, "text"), lookalike_classes(values.sparkSession)
    parts = distinct.withColumn("parts", F.array_distinct(parts_of(F.col("text"), counts, classes))).checkpoint()
    entries = entries.checkpoint()
    keys = parts.select("kind", F.explode("parts").alias("key")).distinct()
    pairs = similar_keys(keys, entries.select("kind", "key"), threshold=threshold)
    close = pairs.where((F.col("jaccard") >= sure) | _one_edit(F.col("key"), F.col("other")))
    named = entries.groupBy("kind", F.col("key").alias("other")).agg(
        F.collect_set(F.when(F.col("ref").isNotNull(), F.struct("ref", "hints"))).alias("entries"), F.max("fuzzy").alias("fuzzy")
    )
    close = close.join(named, ["kind", "other"]).where((F.col("key") == F.col("other")) | F.col("fuzzy"))
    found = close.groupBy("kind", "key").agg(F.max("jaccard").alias("jaccard"), F.collect_list(F.struct("jaccard", "entries")).alias("all"))
    best = found.select(
        "kind",
        "key",
        F.array_distinct(F.flatten(F.transform(F.filter("all", lambda x: x["jaccard"] == F.col("jaccard")), lambda x: x["entries"]))).alias("entries"),
        "jaccard",
    ).where(F.size("entries") > 0)
    spread = parts.select("kind", "text", "parts", F.explode_outer("parts").alias("key"))
    found = spread.join(best, ["kind", "key"], "left")
    told = found.groupBy("kind", "text").agg(
        F.first("parts").alias("parts"), F.collect_list(F.when(F.col("entries").isNotNull(), F.struct("key", "entries", "jaccard"))).alias("found")
    )

    def common(found: Column) -> Column:
        lists = F.transform(found, lambda f: f["entries"])
        return F.aggregate(lists, lists[0], lambda a, x: F.array_intersect(a, x))

    own = common(F.col("found"))
    hinted = F.filter("own", lambda e: F.size(F.array_intersect(e["hints"], F.col("parts"))) > 0)
    told = told.withColumn("own", F.when(F.size("found") > 0, own)).withColumn("hinted", hinted)
    ref = F.when(F.size("own") == 1, F.col("own")[0]["ref"]).when(F.size("hinted") == 1, F.col("hinted")[0]["ref"])
    return told.select("kind", "text", ref.alias("ref"), F.array_min(F.transform("found", lambda f: f["jaccard"])).alias("jaccard"))


def place_entries(places: DataFrame, countries: DataFrame) -> DataFrame:
    """Entries of both kinds: places under ``locations`` (name, other name, name with country) and countries under ``countries``.

    The names of countries stand under ``locations`` too, as entries that mean none."""
    classes = lookalike_classes(places.sparkSession)
    glue = F.pandas_udf(lambda s: s.map(lambda v: None if v is None else folded(v, rewriter((), classes)).replace(" ", "")), "string")
    lands = countries.select(
        F.col("country_code").alias("code"),
        F.filter(F.transform(F.concat(F.array("name"), F.coalesce("other_names", F.array().cast("array<string>"))), lambda n: n), lambda n: n.isNotNull()).alias("names"),
        "iso3_code",
    )
    names = lands.select("code", F.explode(F.transform(F.filter("names", lambda n: n.isNotNull()), lambda n: F.struct(n.alias("n"), F.lit(True).alias("fuzzy")))).alias("x"))
    codes = lands.select("code", F.explode(F.array(*[F.struct(F.col(c).alias("n"), F.lit(False).alias("fuzzy")) for c in ("code", "iso3_code")])).alias("x"))
    keyed = names.unionByName(codes).select("code", glue("x.n").alias("key"), "x.fuzzy").where("key is not null")
    of_lands = keyed.select(F.lit("countries").alias("kind"), "key", F.col("code").alias("ref"), "fuzzy", F.array().cast("array<string>").alias("hints"))
    hints = keyed.groupBy("code").agg(F.collect_set("key").alias("land_keys"))
    main = lands.select(F.col("code"), glue(F.col("names")[0]).alias("land"))
    spots = (
        places.join(hints, places["country_code"] == hints["code"], "left")
        .drop("code")
        .join(main, places["country_code"] == main["code"], "left")
        .select(
            F.col("place_id").cast("string").alias("ref"),
            F.explode(F.array("name", "alt_name")).alias("name"),
            F.array_compact(F.concat(F.array(F.lower("region_code")), F.coalesce("land_keys", F.array().cast("array<string>")))).alias("hints"),
            "land",
        )
        .where("name is not null")
        .withColumn("key", glue("name"))
    )
    plain = spots.select(F.lit("locations").alias("kind"), "key", "ref", F.lit(True).alias("fuzzy"), "hints")
    landed = spots.where("land is not null").select(F.lit("locations").alias("kind"), F.concat("key", "land").alias("key"), "ref", F.lit(True).alias("fuzzy"), "hints")
    # A country alone is no place: where a place is wanted, its names mean no entry.
    bare = of_lands.select(F.lit("locations").alias("kind"), "key", F.lit(None).cast("string").alias("ref"), F.lit(False).alias("fuzzy"), "hints")
    return plain.unionByName(landed).unionByName(of_lands).unionByName(bare).where("key <> ''").distinct()
