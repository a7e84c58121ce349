"""Several values packed in one field, split into one value a row with the position kept.

Quoted and otherwise protected spans are replaced by indexed placeholders made of private-use characters; such characters in
the text itself are protected spans too, so placeholders never collide. The remaining delimiters split the text, the spans come
back by array lookup, and the values are exploded with their positions. Built-in expressions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import let

_OPEN, _CLOSE, _MARK, _COMMA = "\ue000", "\ue001", "\ue002", "\ue003"
_SPACE = "[\\s\\u0085\\u00A0\\u1680\\u2000-\\u200B\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]"
_HELD = f"{_OPEN}\\d+{_CLOSE}"

#: Words that join the last two values of a list, units that belong to the value before them, work modes that
#: belong to the value after them.
JOINING = ["and", "und", "et", "or", "oder", "ou", "y", "og", "och", "&"]
UNITS = ["Unit", "Building", "Bldg", "Gate", "Floor", "Suite", "Room", "Tower", "Block", "Level", "Hall"]
MODES = ["Hybrid", "Remote", "On-site", "Onsite", "On site"]

#: Compound names are tried as alternatives of one pattern; more than this many are refused.
MOST_NAMES = 5000


def _any(words: list[str]) -> str:
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in sorted(words, key=lambda w: (-len(w), w)))


def _protected(compounds: list[str]) -> str:
    names = [f"(?<![\\p{{L}}\\d])(?:{_any(compounds)})(?![\\p{{L}}\\d])"] if compounds else []
    return "|".join(
        [
            f"[{_OPEN}{_CLOSE}{_MARK}{_COMMA}]",
            r'"(?:[^"\\]|\\.|"")*"',
            r"(?<=^|[\[{,;]|[,;]\s)'(?:[^'\\]|\\.)*'(?=\s*(?:[,;\]}]|$))",
            r"\((?!\d{1,3}\)\s)[^()]*\)",
            r"\\.",
            *names,
        ]
    )


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_SPACE}+|{_SPACE}+$", "")


def _bare(span: Column) -> Column:
    """A span without its outer quotes and escapes."""
    inner = F.substring(span, F.lit(2), F.length(span) - 2)
    double = F.regexp_replace(F.regexp_replace(inner, '""', '"'), r"\\(.)", "$1")
    single = F.regexp_replace(inner, r"\\(.)", "$1")
    return F.when(span.rlike('(?s)^".*"$') & (F.length(span) > 1), double).when(span.rlike("(?s)^'.*'$") & (F.length(span) > 1), single).otherwise(span)


def packed_values(text: Column, *, compounds: list[str] | None = None, qualifiers: list[str] | None = None) -> Column:
    """The values packed in ``text`` as an array, in order, empty ones dropped, repeats kept.

    Delimiters: line breaks, tabs, ``;`` ``|`` bullets, middle dots, `` / ``, `` // ``, `` + ``, ideographic commas and list marks
    (``1.``, ``1)``, ``(1)``, ``-``, ``*``); arrays as JSON, Python or PostgreSQL write them; without any of these also commas and the joining
    word before the last value. A comma splits nothing where what follows belongs to the value before it: a code of two or three
    capitals, one of ``qualifiers`` (country names), a unit such as ``Building 2``; nor after a leading work mode. With whole
    values in quotes or escaped commas every other comma splits. Spans in quotes or brackets stay together, and so do the
    ``compounds`` (names that contain a joining word).

    Null gives null, blank text an empty array. The length of the text is not limited.
    """
    compounds, qualifiers = compounds or [], qualifiers or []
    if len(compounds) + len(qualifiers) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    whole = _strip(text)
    boxed = whole.rlike(r"(?s)^(?:\[.*\]|\{.*\})$")
    inner = F.when(boxed, F.substring(whole, F.lit(2), F.length(whole) - 2)).otherwise(whole)
    protected = _protected(compounds)

    listed = r"^\s*\(?1[.)]\s"
    strong = rf"{_MARK}|[\r\n\t;；|•·、]|\s//?\s|\s\+\s|(?<=\p{{L}}{{3}})/(?=\p{{Lu}}\p{{L}}{{2}})(?!Remote|Hybrid|On)"
    tail = rf"(?:[A-Z]{{2,3}}|(?:{_any(UNITS)})\.?\s+[\w/\-]+" + (f"|{_any(qualifiers)}" if qualifiers else "") + ")"
    lead = rf"((?:^|[,，]\s*)(?:\d[^,，]*|(?:{_any(MODES)})(?:\s*{_HELD})?)\s*)[,，]"
    joining = rf"\s(?:{_any(JOINING)})\s"

    def cut(masked: Column, spans: Column, boxed: Column) -> Column:
        numbered = F.regexp_replace(masked, r"(?:^|(?<=[\s;,|]))\(?\d{1,3}[.)]\s+", _MARK)
        return let(F.when(masked.rlike(listed), numbered).otherwise(masked), lambda marked: divided(marked, spans, boxed))

    def divided(marked: Column, spans: Column, boxed: Column) -> Column:
        whole_values = marked.rlike(rf"(?:^|[,;])\s*{_HELD}\s*(?:[,;]|$)") & F.exists(spans, lambda s: s.rlike("(?s)^[\"'].*[\"']$"))
        every = boxed | F.when(F.size(spans) > 0, whole_values | F.exists(spans, lambda s: s == "\\,")).otherwise(False)
        some = F.regexp_replace(F.regexp_replace(marked, joining, ", "), rf"[,，](?=\s*{tail}\s*(?:[,，]|$))", _COMMA)
        some = F.regexp_replace(some, lead, f"$1{_COMMA}")
        return (
            F.when(marked.rlike(strong), F.split(marked, strong, -1))
            .when(every, F.split(marked, "[,，]", -1))
            .when(marked.rlike(rf"[,，]|{joining}"), F.transform(F.split(some, "[,，]", -1), lambda p: F.translate(p, _COMMA, ",")))
            .otherwise(F.array(marked))
        )

    def restored(piece: Column, spans: Column) -> Column:
        alone = piece.rlike(f"^{_SPACE}*{_HELD}{_SPACE}*$")
        at = F.regexp_extract_all(piece, F.lit(f"{_OPEN}(\\d+){_CLOSE}"), 1)

        def back(part: Column, i: Column) -> Column:
            span = F.get(spans, F.get(at, i).cast("int"))
            freed = F.when(alone, _bare(span)).when(span.rlike(r"^\\.$"), F.substring(span, 2, 1)).otherwise(span)
            return F.concat(part, F.coalesce(freed, F.lit("")))

        return F.array_join(F.transform(F.split(piece, _HELD, -1), back), "")

    def boxed_up(s: Column) -> Column:
        # Each span and each part between spans is found once, whatever their number.
        found = F.struct(F.split(s["t"], protected, -1).alias("parts"), F.regexp_extract_all(s["t"], F.lit(protected), 0).alias("spans"), s["boxed"].alias("boxed"))
        return F.when(s["t"].rlike(suspect), let(found, placed)).otherwise(cut(s["t"], F.array().cast("array<string>"), s["boxed"]))

    def placed(s: Column) -> Column:
        held = F.transform(s["parts"], lambda p, i: F.when(i < F.size(s["spans"]), F.concat(p, F.lit(_OPEN), i.cast("string"), F.lit(_CLOSE))).otherwise(p))
        pieces = let(F.array_join(held, ""), lambda m: cut(m, s["spans"], s["boxed"]))
        return F.transform(pieces, lambda p: F.when(p.contains(_OPEN), let(p, lambda q: restored(q, s["spans"]))).otherwise(p))

    suspect = f"[\"'(\\\\{_OPEN}{_CLOSE}{_MARK}{_COMMA}]" + (f"|{joining}" if compounds else "")
    values = let(F.struct(inner.alias("t"), boxed.alias("boxed")), boxed_up)
    clean = F.transform(values, lambda v: _strip(F.regexp_replace(_strip(v), r"^(?:[-–*•·]\s+|\(\d{1,3}\)\s+)", "")))
    return F.when(text.isNotNull(), F.filter(clean, lambda v: (v != "") & ~v.rlike(r"^[-–*•·,;|/]+$")))


def split_packed(
    rows: DataFrame, text: str, *, least: int = 1, compounds: list[str] | None = None, qualifiers: list[str] | None = None
) -> DataFrame:
    """``rows`` with one row per value of ``text``: ``pos`` (from 1) and ``piece`` are added; see :func:`packed_values`.

    Rows with fewer than ``least`` values (null and blank texts have none) give no row. Repeated rows stay repeated, extra
    columns stay, but columns named ``pos`` or ``piece`` are replaced. No shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("pos", "piece")]).alias("_row")
    values = rows.select(row, packed_values(F.col(text), compounds=compounds, qualifiers=qualifiers).alias("_values"))
    kept = values.where(F.size("_values") >= least)
    return kept.select("_row", F.posexplode("_values").alias("_i", "piece")).select("_row.*", (F.col("_i") + 1).alias("pos"), "piece")
