"""Board endpoints and a data source that reads stored provider pages under the limits of a live scan."""

from __future__ import annotations

import json
import os
import re
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Where the providers answer. ``{b}`` is the percent-encoded board token, ``{h}`` the token in lower case.
ENDPOINTS = {
    "greenhouse": "https://boards-api.greenhouse.io/v1/boards/{b}/jobs?content=true",
    "lever": "https://api.lever.co/v0/postings/{b}?mode=json",
    "ashby": "https://api.ashbyhq.com/posting-api/job-board/{b}",
    "workable": "https://apply.workable.com/api/v1/widget/accounts/{b}?details=true",
    "usajobs": "https://data.usajobs.gov/api/Search?ResultsPerPage=500&Fields=Full&Organization={b}",
    "teamtailor": "https://{h}/jobs.json",
    "recruitee": "https://{h}.recruitee.com/api/offers/",
    "breezy": "https://{h}.breezy.hr/json",
    "pinpoint": "https://{h}.pinpointhq.com/postings.json",
}
LEVER_EU = "https://api.eu.lever.co/v0/postings/{b}?mode=json"
#: Keys of a response that mean there is more than one page.
PAGING_KEYS = ["next", "nextPage", "nextCursor", "hasMore", "hasNextPage", "next_url"]
#: Sources read page by page, with the bytes and pages a board may have.
PAGED = {"lever": (24 << 20, 1000), "usajobs": (128 << 20, 20), "teamtailor": (24 << 20, 25)}
ONE_BODY = 24 << 20
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"


def board_url(source: str, token: str, eu: bool = False) -> str:
    """The address of a board; ``ValueError('INVALID_BOARD')`` for a token that could address something else."""
    if source not in ENDPOINTS:
        raise ValueError("INVALID_BOARD")
    inner = " " if source == "ashby" else ""
    ok = re.fullmatch(rf"[\w.-](?:[\w.{inner}-]{{0,198}}[\w.-])?", token, re.ASCII)
    if source == "teamtailor":
        ok = ok and re.fullmatch(rf"{_LABEL}(?:\.{_LABEL})+", token)
    elif source in ("recruitee", "breezy", "pinpoint"):
        ok = ok and re.fullmatch(_LABEL, token)
    if not ok:
        raise ValueError("INVALID_BOARD")
    if source == "usajobs" and token.lower() == "all":
        return ENDPOINTS[source].partition("&Organization")[0]
    pattern = LEVER_EU if source == "lever" and eu else ENDPOINTS[source]
    return pattern.format(b=quote(token, safe=""), h=token.lower())


def read_body(path: str, most: int = ONE_BODY) -> tuple[str | None, str | None]:
    """(text, error) of one stored response: strict UTF-8 JSON within ``most`` bytes."""
    if os.path.getsize(path) > most:
        return None, "BODY_TOO_LARGE"
    with open(path, "rb") as file:
        raw = file.read()
    if not raw.strip():
        return None, "EMPTY_RESPONSE"
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None, "INVALID_ENCODING"
    try:
        json.loads(text)
    except ValueError:
        return None, "INVALID_JSON"
    return text, None


class BoardPartition(InputPartition):
    def __init__(self, source: str, board: str, files: list[str]):
        self.source, self.board, self.files = source, board, files


class BoardReader(DataSourceReader):
    """One partition per board: its pages are read in order, and the first error ends the board."""

    def __init__(self, root: str):
        self.root = root

    def partitions(self):
        made = []
        for source in sorted(os.listdir(self.root)):
            for board in sorted(os.listdir(os.path.join(self.root, source))):
                folder = os.path.join(self.root, source, board)
                made.append(BoardPartition(source, board, [os.path.join(folder, f) for f in sorted(os.listdir(folder))]))
        return made or [BoardPartition("", "", [])]

    def read(self, partition):
        budget, pages = PAGED.get(partition.source, (ONE_BODY, 1))
        used = 0
        for number, path in enumerate(partition.files):
            body, error = read_body(path)
            used += len(body.encode()) if body else 0
            if error is None and number >= pages:
                body, error = None, "UNEXPECTED_PAGINATION"
            if error is None and used > budget:
                body, error = None, "BOARD_TOO_LARGE"
            yield partition.source, partition.board, number, body, error
            if error:
                return


class BoardSource(DataSource):
    """``spark.read.format("posting_boards").load(folder)`` with ``folder/<source>/<board>/<page>.json``."""

    @classmethod
    def name(cls) -> str:
        return "posting_boards"

    def schema(self) -> str:
        return "source string, board string, page_no int, body string, error string"

    def reader(self, schema):
        return BoardReader(self.options["path"])


def unexpected_paging(body: Column) -> Column:
    """Whether a whole-board response says that there is more."""
    parsed = F.try_parse_json(body)
    truthy = [F.coalesce(F.try_variant_get(parsed, f"$.{k}", "string"), F.lit("")) for k in PAGING_KEYS]
    return F.array_contains(F.array(*[(t != "") & (F.lower(t) != "false") & (t != "0") for t in truthy]), True)


def description_block(page: Column) -> Column:
    """The inner HTML of the first ``div`` of class description, found by depth; null without one or when it never closes.

    Tags are folded in order; the text up to the tag where the depth comes back to zero is kept.
    """
    opened = r"""(?is)<div\b[^>]*\bclass=["'](?:[^"']*\s)?description(?:\s[^"']*)?["'][^>]*>"""
    rest = F.regexp_extract(page, opened + "(.*)$", 1)
    tag = r"(?i)</?div\b[^>]*>"

    def step(s: Column, part: Column, tag_text: Column) -> Column:
        depth = s["depth"] + F.when(tag_text.startswith("</"), -1).otherwise(1)
        done = s["done"] | (depth == 0)
        out = F.when(s["done"], s["out"]).otherwise(F.concat(s["out"], part, F.when(depth == 0, "").otherwise(tag_text)))
        return F.struct(F.when(s["done"], s["depth"]).otherwise(depth).alias("depth"), done.alias("done"), out.alias("out"))

    tags = F.regexp_extract_all(rest, F.lit(tag), 0)
    pairs = F.zip_with(F.slice(F.split(rest, tag, -1), F.lit(1), F.size(tags)), tags, lambda p, t: F.struct(p.alias("p"), t.alias("t")))
    start = F.struct(F.lit(1).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("out"))
    folded = F.aggregate(pairs, start, lambda s, x: step(s, x["p"], x["t"]))
    return F.when(page.rlike(opened) & folded["done"], folded["out"])


def with_pages(listed: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """The list of a board joined to its detail pages (``url``, ``html``): a missing page leaves the description null."""
    return listed.join(pages.select(F.col("url").alias(url), description_block(F.col("html")).alias("page_description")), url, "left")
