"""Token counts of texts by a public tokenizer whose files lie outside the library."""

from __future__ import annotations

import base64
import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies; a parameter, never copied.
VOCABULARY = os.environ.get("POSTLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the splitting pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts longer than this are counted in pieces cut at white space, so that one huge text needs no huge buffer.
PIECE = 200_000

_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The encoder of a vocabulary file, loaded once a process."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("postloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    if not text:
        return 0
    encode, total, at = encoding(path).encode_ordinary, 0, 0
    while len(text) - at > PIECE:
        cut = text.rfind(" ", at + 1, at + PIECE)
        cut = cut if cut > at else at + PIECE
        total += len(encode(text[at:cut]))
        at = cut
    return total + len(encode(text[at:]))


def token_counts(text: Column, path: str = VOCABULARY) -> Column:
    """The number of tokens of ``text``; 0 for null and empty texts."""

    @F.pandas_udf("bigint")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: count_tokens(t, path)).astype("int64")

    return counted(text)


def sized_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``documents`` without ``text`` but with ``tokens``."""
    rest = [c for c in documents.columns if c not in (text, "tokens")]
    return documents.select(*rest, token_counts(F.col(text), path).alias("tokens"))
