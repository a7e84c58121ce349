"""Text column functions: scrubbing, cutting, HTML to text, joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The tags whose markup is known and replaced by a space.
TAGS = (
    "html body head title meta link a abbr address article aside b blockquote button caption code col dd del details div dl dt em fieldset "
    "figcaption figure font footer form h[1-6] header hr i iframe img input label legend li main nav ol option p pre s section select small "
    "span strong sub summary sup table tbody td textarea th thead time tr u ul"
).split()
_STRUCTURE = "(?:html|body|p|div|span|ul|ol|li|h[1-6]|br|section|article|table|strong|em)"
#: The named entities that are decoded.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def clean(text: Column) -> Column:
    """Null as empty text; NUL dropped, other control characters but tab and line breaks as spaces."""
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\0"), F.lit("")), "[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F]", " ")


def cut(text: Column, size: int) -> Column:
    """The first ``size`` code points."""
    return F.substring(text, 1, size)


def decode_entities(text: Column) -> Column:
    """Named and numeric entities in one pass: what a decoded entity spells is not decoded again.

    The text is cut at entities and each is looked up once; numbers beyond Unicode and surrogates stay as written.
    """
    pattern = r"(?i)&(?:#x[\da-f]+|#\d+|amp|lt|gt|quot|apos|nbsp);"
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def point(entity: Column) -> Column:
        body = F.lower(F.regexp_extract(entity, "&#?(.*);", 1))
        number = F.when(body.startswith("x"), F.conv(F.substring(body, 2, 9), 16, 10)).otherwise(F.substring(body, 1, 9)).cast("bigint")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        # UTF-16BE with surrogate pairs, decoded by the JVM.
        high, low = F.lit(0xD800) + F.shiftright(number - 0x10000, 10), F.lit(0xDC00) + (number - 0x10000).bitwiseAND(0x3FF)
        units = F.when(number < 0x10000, F.lpad(F.hex(number), 4, "0")).otherwise(F.concat(F.lpad(F.hex(high), 4, "0"), F.lpad(F.hex(low), 4, "0")))
        return F.when(~entity.startswith("&#"), names[F.lower(F.regexp_extract(entity, "&(.*);", 1))]).when(valid, F.decode(F.unhex(units), "UTF-16BE")).otherwise(entity)

    def joined(s: Column) -> Column:
        return F.array_join(F.transform(s["parts"], lambda p, i: F.concat(p, F.coalesce(point(F.get(s["found"], i)), F.lit("")))), "")

    def once(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(pattern), 0)
        made = let(F.struct(F.split(t, pattern, -1).alias("parts"), found.alias("found")), joined)
        return F.when(t.rlike(pattern), made).otherwise(t)

    return let(text, once)


def plain_text(html: Column) -> Column:
    """HTML as text: an escaped document layer is unwrapped (twice at most), scripts, styles and comments go, block ends and
    ``br`` become line breaks, known tags spaces; entities are decoded last, so escaped literals such as ``&lt;T&gt;`` survive."""
    literal, escaped = rf"(?i)</?{_STRUCTURE}\b", rf"(?i)&(?:amp;)?lt;/?{_STRUCTURE}(?:&|\s|>)"
    for _ in range(2):
        html = let(html, lambda h: F.when(~h.rlike(literal) & h.rlike(escaped), decode_entities(h)).otherwise(h))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?i)<\s*(?:br\b[^>]*|/(?:p|div|li|h[1-6]))\s*/?>", "\n")
    text = F.regexp_replace(text, rf"(?i)</?(?:{'|'.join(TAGS)})\b[^>]*>", " ")
    text = F.regexp_replace(decode_entities(text), "[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r"\n\s*\n\s*\n+", "\n\n"), r"^\s+|\s+$", "")


def sections(*parts: tuple[str | None, Column]) -> Column:
    """Non-blank parts with optional headings, joined by blank lines; null when none is left."""

    def headed(head: str | None, text: Column) -> Column:
        return let(text, lambda t: F.when(F.trim(t) != "", F.concat(F.lit(f"{head}\n" if head else ""), t)))

    made = F.array(*[headed(head, text) for head, text in parts])
    return F.nullif(F.array_join(F.array_compact(made), "\n\n"), F.lit(""))


def joined(*parts: Column) -> Column:
    """Trimmed, distinct, non-blank parts joined by ``, ``; null when none is left."""
    kept = F.filter(F.array(*[F.trim(p) for p in parts]), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.array_join(F.array_distinct(kept), ", "), F.lit(""))


def safe_url(url: Column) -> Column:
    """Whether a URL is http(s), has a host and no user information."""
    web = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https")
    return F.coalesce(web & F.try_parse_url(url, F.lit("HOST")).isNotNull() & F.try_parse_url(url, F.lit("USERINFO")).isNull(), F.lit(False))


def quote_of(text: Column, size: int = 200) -> Column:
    """White space squeezed, outer white space dropped, at most ``size`` code points."""
    return F.substring(F.trim(F.regexp_replace(text, r"\s+", " ")), 1, size)
