"""Sentence units of texts in many languages and scripts, in SQL expressions only.

End marks that end nothing (in decimals, URLs, initials, abbreviations, list items, and inside quotations or brackets of a longer
sentence) are replaced one for one by private-use characters. What is left is split by regular expressions for the scripts. As
the replacement keeps every position, the units are restored as spans of the original text, whatever characters it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import let

#: Pieces whose places are worked out together.
_BLOCK = 256
_DOT, _GAP, _LEFT, _RIGHT = "\ue000", "\ue001", "\ue003", "\ue004"
_ENDS = ".!?…؟۔।॥|;;。！？｡．"
_WS = "[\\s\\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
_CJK = "\\u3040-\\u30FF\\u3400-\\u4DBF\\u4E00-\\u9FFF\\uF900-\\uFAFF\\uFF66-\\uFF9F\\uAC00-\\uD7AF"
_CASELESS = _CJK + "\\u0600-\\u06FF\\u0900-\\u0DFF\\u0E00-\\u0EFF"
_WORD = "\\p{L}\\p{M}\\p{N}"

#: Abbreviations that never end a sentence, by language, without their last dot.
NEVER_LAST = (
    "Mr Mrs Ms Mx Dr Prof Rev Hon Gen Col Capt Lt Sgt St Mt Messrs vs approx dept est "  # English
    "Hr Fr Frl Abt bzw ca Dipl Ing "  # German
    "Mme Mlle MM env "  # French
    "Sr Sra Srta Dra Dña aprox EE "  # Spanish
    "Sig Dott Exmo "  # Italian, Portuguese
    "г-н г-жа проф акад им ул гр см "  # Russian
    "κ κα κκ π.χ δηλ "  # Greek
    "د أ م ا "  # Arabic
    "डॉ श्री प्रो"  # Hindi
).split()
#: Abbreviations that stand before a number.
BEFORE_NUMBER = (
    "No Nos no nos Nr Nrn nr n p pp P S Fig Figs fig sec Sec Ch ch Vol vol Art art Abs Bd Kap pág págs Ver ver v núm cap Eq eq гл рис стр с № σελ αρ"
).split()
#: German months and periods that follow an ordinal number.
AFTER_ORDINAL = (
    "Januar Februar März April Mai Juni Juli August September Oktober November Dezember Jahrhundert Quartal Stock Semester Klasse"
).split()
_INNER = ["e.g", "i.e", "z.B", "d.h", "u.a", "s.o", "p.ej", "p. ej", "c.-à-d", "cf", "z. B", "d. h", "u. a", "т.е", "т. е", "& Co"]


def _any(words: list[str]) -> str:
    escaped = [w.replace(".", f"[.{_DOT}]").replace("-", "\\-").replace(" ", _WS) for w in sorted(words, key=lambda w: (-len(w), w))]
    return "|".join(escaped)


_LIST = r"(?:[-*•·▪◦‣–]|\d{1,3}[.)]|\(\d{1,3}\))"
_ITEM = rf"(?m)^[ \t]*{_LIST}[ \t ][^\n]*(?:\n(?![ \t]*(?:\n|{_LIST}[ \t ]))[^\n]*)*"
_BLANK = r"\n[ \t \r]*\n"
_IN = rf"(?:(?!{_BLANK})[^%s])*+"
#: Quotations and brackets, each within one block.
_PAIRS = [
    f"„{_IN % '„“”'}[“”]",
    f"“{_IN % '“”'}”",
    f"«{_IN % '«»'}»",
    f"‹{_IN % '‹›'}›",
    f"\"{_IN % chr(34)}\"",
    rf"‘(?:(?!{_BLANK})(?:[^‘’]|(?<=\p{{L}})’(?=\p{{L}})))*+’",
    f"「{_IN % '「」'}」",
    f"『{_IN % '『』'}』",
    f"（{_IN % '（）'}）",
    rf"\({_IN % '()'}\)",
    rf"\[{_IN % (chr(92) + '[' + chr(92) + ']')}\]",
]
_SPAN = "|".join(_PAIRS)

#: A new sentence directly behind an end mark, the space forgotten.
_TIGHT = "(?:[“„«]?\\p{Lu}\\p{Ll}|(?<=\\p{Ll}{2}[.?!])\\p{Lu}\\s)"

#: Masks in order: end marks inside words (decimals, URLs, acronyms), marks of list items, initials, abbreviations, ordinals.
#: Each begins with the mark itself, so the look-arounds are tried at marks only.
_MASKS = [
    rf"[.?!](?=[{_WORD}_/%=&\-])(?![{_CJK}])(?<=[{_WORD}_/:@%\-][.?!])(?:(?<!\p{{Ll}}[.?!])|(?!{_TIGHT}))",
    rf"(?m)\.(?=[ \t ])(?<=^[ \t]{{0,12}}\d{{1,3}}\.)",
    rf"\.(?={_WS}+\p{{Lu}})(?<=(?<![{_WORD}{_DOT}.])\p{{Lu}}\.)",
    rf"\.(?={_WS}?\p{{L}}[.{_DOT}])(?<=(?<![{_WORD}{_DOT}])\p{{L}}\.)",
    rf"\.(?<=(?<![{_WORD}{_DOT}])(?:{_any(NEVER_LAST)})\.)",
    rf"\.(?<=(?<![{_WORD}{_DOT}])(?:{_any(_INNER)})\.)",
    rf"\.(?={_WS}*\d)(?<=(?<![{_WORD}{_DOT}])(?:{_any(BEFORE_NUMBER)})\.)",
    rf"\.(?={_WS}+(?:{'|'.join(AFTER_ORDINAL)})(?![{_WORD}]))(?<=\d\.)",
    rf"\.(?=\p{{L}})(?<=(?:^|\n)\.)",
]

#: Marks inside words first, as what they become is looked at by the others; these look at one another's marks either way.
_PASSES = [_MASKS[0], "|".join(_MASKS[1:])]

_CLOSE = "[\"'”’“»›)\\]」』）]"
_SHUT = "[\"'”’»)\\]」』）]"
_LATIN_ENDS = f"(?:[.!?…؟۔।॥]|(?<=[\\u0900-\\u097F])\\||(?<=[\\u0370-\\u03FF\\u1F00-\\u1FFF])[;;])"
_END = f"(?:{_LATIN_ENDS}{_CLOSE}{{0,4}}|{_LATIN_ENDS}[ \\u00A0\\u202F\\n][»›])"
#: What continues a sentence after an end mark: a lower-case word (but for words such as iOS), a dash, comma or closing mark.
_GOES_ON = f"{_WS}*(?:[\"'“„«‹(\\[‘¿¡]*(?:{_WS}(?=\\p{{Ll}}))?\\p{{Ll}}(?!\\p{{Ll}}*\\p{{Lu}})|[,;:—–](?!\\p{{L}})|-{_WS}|[)\\]»”›])"
_WIDE = "[。！？｡]"
#: Boundaries before white space, and behind end or closing marks.
_BEFORE_SPACE = [
    rf"(?={_BLANK})(?<!\n[ \t \r]{{0,9}})",
    rf"(?=\n[ \t]*(?:[-*•·▪◦‣–]|\d{{1,3}}[.){_DOT}]|\(\d{{1,3}}\))[ \t {_GAP}])",
    rf"(?={_WS})(?<![{_WORD},])(?<={_END})(?!{_GOES_ON})",
    r"(?<=[฀-๿])(?=[  \n]+[฀-๿])",
]
_BEHIND_MARK = [
    rf"(?<=\p{{Ll}}[.?!])(?={_TIGHT})",
    rf"(?<=[。！？｡\"'”’»)\]」』）])(?<={_WIDE}{_SHUT}{{0,4}})(?!{_WIDE}|{_SHUT}|{_WS}*$)",
    rf"(?<=[!?\"'”’»)\]」』）])(?<=[{_CJK}][!?]{_SHUT}{{0,3}})(?=[{_CJK}「『（“])",
]
#: Two one-range tests turn most places away before any of the look-arounds is tried.
_BOUNDARY = (
    rf"(?![!-~\u00A1-\u167F])(?:{'|'.join(_BEFORE_SPACE)})|(?<![0-9A-Za-z\s\u00C0-\u1FFF])(?:{'|'.join(_BEHIND_MARK)})"
)


def _masked(text: Column, marks: str = _ENDS) -> Column:
    return F.translate(text, marks, _DOT * len(marks))


def _each_span(text: Column, pattern: str, signs: list[str], change) -> Column:
    """``text`` with ``change`` applied to every match of ``pattern``; all else is kept, and so are texts without any of ``signs``.

    The matches are bracketed in one pass and found again by the brackets, which ``text`` must not hold.
    """

    def cut(t: Column) -> Column:
        parts = F.split(F.regexp_replace(t, f"({pattern})", f"{_LEFT}$1{_RIGHT}"), f"[{_LEFT}{_RIGHT}]", -1)
        changed = F.transform(parts, lambda p, i: F.when(i % 2 == 1, let(p, change)).otherwise(p))
        some = t.rlike(signs[0])
        for sign in signs[1:]:
            some = some | t.rlike(sign)
        return F.when(some, F.array_join(changed, "")).otherwise(t)

    return let(text, cut)


def unit_spans(text: Column) -> Column:
    """The sentence units of ``text`` as ARRAY<STRUCT<start_pos, end_pos>>: code points from 0, end exclusive, no outer white space.

    A blank line always ends a unit; a list item is a unit with its mark; other single line breaks are like spaces. Closing
    quotes and brackets belong to their unit. An end mark inside a quotation or bracket ends a unit only at its end and only
    where the sentence does not go on: with a lower-case word or a dash in scripts with letter case; in scripts without, where
    no colon introduces the quotation. Colons and semicolons end nothing but the Greek question mark. Between Thai letters a
    space ends a unit. Null and blank texts have no units. Texts of any length are read whole.
    """
    lined = F.translate(text, "  \u000b\u000c", "\n\n\n\n")
    lined = F.regexp_replace(F.regexp_replace(lined, "\r(?=\n)", " "), "\r", "\n")
    # Private-use characters of the text itself are no placeholders: another character takes their place, for the search only.
    clear = F.translate(lined, _DOT + _GAP + _LEFT + _RIGHT, "\ue002" * 4)
    mark = rf"^([ \t]*{_LIST})"

    def item(span: Column) -> Column:
        head = F.regexp_extract(span, mark, 1)
        return F.concat(head, F.translate(_masked(F.substring(span, F.length(head) + 1, F.length(span))), "  ", _GAP * 2))

    listed = _each_span(clear, _ITEM, [rf"\n[ \t]*{_LIST}[ \t ]", rf"^[ \t]*{_LIST}[ \t ]"], item)
    masked = listed
    for mask in _PASSES:
        masked = F.regexp_replace(masked, mask, _DOT)
    inside = f"(?s)[{_ENDS}](?=.*[{_WORD}])"
    told = rf"(?![0-9A-Za-z \u00C0-\u1FFF])(?:[：:]\s?)?(?:{_SPAN})"  # a colon before the span says that the quotation ends the sentence
    caseless = f"^.(?:(?![\\p{{Lu}}\\p{{Ll}}])(?s:.))*[{_CASELESS}]"

    def quotation(span: Column) -> Column:
        goes_on = ~span.rlike("^[：:]") & span.rlike(caseless)
        return F.when(goes_on, _masked(span)).otherwise(F.regexp_replace(span, inside, _DOT))

    quoted = _each_span(masked, told, ["[„“«‹\"‘「『（(\\[]"], quotation)
    pieces = F.split(quoted, _BOUNDARY, -1)

    none = F.array().cast("array<struct<start_pos:int,end_pos:int>>")

    def grow(acc: Column, piece: Column) -> Column:
        start = acc["at"] + piece["lead"]
        unit = F.struct(start.alias("start_pos"), (acc["at"] + piece["end"]).alias("end_pos"))
        return F.struct((acc["at"] + piece["size"]).alias("at"), F.concat(acc["out"], F.array(unit)).alias("out"))

    def measured(piece: Column) -> Column:
        size = F.length(piece)
        lead = F.when(piece.rlike(f"^[{_WS[1:-1]}{_GAP}]"), size - F.length(F.regexp_replace(piece, f"^[{_WS[1:-1]}{_GAP}]+", ""))).otherwise(0)
        end = F.when(piece.rlike(f"[{_WS[1:-1]}{_GAP}]$"), F.length(F.regexp_replace(piece, f"[{_WS[1:-1]}{_GAP}]+$", ""))).otherwise(size)
        return F.struct(size.alias("size"), lead.alias("lead"), end.alias("end"))

    def placed(found: Column) -> Column:
        # Blocks of pieces, then the blocks: an array that grows by one is copied each time, which long texts must not pay.
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int")), lambda i: F.slice(found, i * _BLOCK + 1, F.lit(_BLOCK)))
        counted = F.transform(blocks, lambda block: F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("out")), grow))
        shift = lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"),
            F.concat(acc["out"], F.array(F.transform(b["out"], lambda u: F.struct((u["start_pos"] + acc["at"]).alias("start_pos"), (u["end_pos"] + acc["at"]).alias("end_pos"))))).alias("out"),
        )
        nothing = F.array().cast("array<array<struct<start_pos:int,end_pos:int>>>")
        return F.flatten(F.aggregate(counted, F.struct(F.lit(0).alias("at"), nothing.alias("out")), shift, lambda acc: acc["out"]))

    spans = let(F.transform(pieces, lambda p: measured(p)), placed)
    return F.filter(spans, lambda u: u["end_pos"] > u["start_pos"])


def sentence_units(documents: DataFrame, text: str = "text", *, keep_text: bool = True) -> DataFrame:
    """One row per sentence unit of each row: ``unit_no`` (from 1), ``start_pos``, ``end_pos`` and, if kept, ``unit``.

    The columns of ``documents`` other than ``text`` stay; those with one of these names are replaced. See :func:`unit_spans`; rows without units
    (null, empty or blank text) give no row, repeated rows stay repeated. No shuffle.
    """
    rest = [c for c in documents.columns if c not in (text, "unit_no", "start_pos", "end_pos", "unit", "_i", "_u")]
    spans = documents.select(*rest, text, F.posexplode(unit_spans(F.col(text))).alias("_i", "_u"))
    unit = [F.substring(F.col(text), F.col("_u.start_pos") + 1, F.col("_u.end_pos") - F.col("_u.start_pos")).alias("unit")] if keep_text else []
    return spans.select(*rest, (F.col("_i") + 1).alias("unit_no"), "_u.start_pos", "_u.end_pos", *unit)
