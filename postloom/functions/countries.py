"""Structured country fields: codes and names of all countries, built from the Unicode library that Spark ships."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Region codes that are deprecated, reserved or groupings, and so no countries.
NO_COUNTRY = "AC AN BU CP CS DD DG EA EU EZ FX IC NT QO SU TA TP UN XA XB YD YU ZR ZZ".split()
#: The markets whose names are known in several languages, and those languages.
MARKETS = "US CA AU GB IN SG JP".split()
LANGUAGES = "en fr ja hi ta zh ms".split()
#: Written forms that the library does not name.
EXTRA = {"united states of america": "US", "great britain": "GB", "日本国": "JP", "uk": "GB"}


@lru_cache(maxsize=4)
def _names(spark: SparkSession) -> tuple[tuple[str, str], ...]:
    locale = spark._jvm.com.ibm.icu.util.ULocale
    english = locale("en")
    made: dict[str, str] = {}
    for code in sorted(c for c in locale.getISOCountries() if c not in NO_COUNTRY):
        here = locale(f"und_{code}")
        name = here.getDisplayCountry(english)
        made[code.lower()] = code
        if three := here.getISO3Country():
            made.setdefault(three.lower(), code)
        if name and name != code:
            made.setdefault(name.lower(), code)
        if code in MARKETS:
            for language in LANGUAGES:
                made.setdefault(here.getDisplayCountry(locale(language)).lower(), code)
    return tuple(sorted({**made, **EXTRA}.items()))


def country_dimension(spark: SparkSession) -> DataFrame:
    """(``written``, ``code``): lower-case two- and three-letter codes and names of every country; about 800 rows, a fixed size."""
    return spark.createDataFrame(list(_names(spark)), "written string, code string")


def structured_country(rows: DataFrame, field: str, out: str = "country_code") -> DataFrame:
    """``rows`` with ``out``: the country that a structured field states by code or name; null for anything else.

    Outer spaces and letter case do not matter. The dimension has a fixed size and is broadcast; no shuffle.
    """
    dimension = F.broadcast(country_dimension(rows.sparkSession).withColumnRenamed("code", "_code"))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != out]).alias("_row")
    keyed = rows.select(row, F.lower(F.trim(F.col(field))).alias("written"))
    return keyed.join(dimension, "written", "left").select("_row.*", F.col("_code").alias(out))
