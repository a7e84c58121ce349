"""One consistent form for texts that look the same but differ in their characters.

Two kinds of classes are found by union-find over strings and code points. *Form* classes join a character with its plain
composed form (full-width, mathematical, ligature, decomposed, no-break and invisible characters); their representative is that
plain form. *Look-alike* classes join, transitively, the letters that the Unicode confusables data (as ICU ships it with Spark)
gives the same skeleton; the representative of a class in a script and letter case is the ordinary member that the corpus uses
most. Texts are rewritten greedily, longest match first, by multi-pattern automata: forms everywhere, letters of a look-alike class
inside words whose letters mix look-alike scripts, phonetic letters that look like an ordinary letter of their script everywhere.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter, defaultdict
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCRIPTS = ("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee")
#: Letters of the scripts that plain words are written with; only they stand for a class.
ORDINARY_BLOCKS = {"Latin": (0x41, 0x180), "Greek": (0x370, 0x3D0), "Cyrillic": (0x400, 0x460), "Armenian": (0x530, 0x590), "Cherokee": (0x13A0, 0x13F6)}
#: Blocks of phonetic letters.
PHONETIC_BLOCKS = ((0x250, 0x2B0), (0x1D00, 0x1D80))
#: Small letters with the shape of a Latin one that the confusables data join with small capitals only.
ALSO_ALIKE = ("κk", "кk", "τt", "χx")
#: Ordinary letters that compatibility decomposition would take apart.
ORDINARY = {"ª", "º", "ำ", "ຳ", "ໜ", "ໝ"}
#: Characters without a glyph that are neither format nor control characters.
BLANKS = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ"
#: Texts of these characters only are in the consistent form already; everything else goes through the automaton.
_PLAIN = "\\x20-\\x7E\\t\\r\\n" + "".join(
    chr(c) for c in range(0xC0, 0x180) if unicodedata.normalize("NFKC", chr(c)) == chr(c) and chr(c).isalpha()
) + "ぁ-ゖァ-ー一-鿿‐‒-―‘-‟•"
SUSPECT = f"[^{_PLAIN}]"


class UnionFind:
    """Disjoint sets of strings; the classes are transitive by construction."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, item: str) -> str:
        self.parent.setdefault(item, item)
        root = item
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[item] != root:
            self.parent[item], item = root, self.parent[item]
        return root

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def classes(self) -> list[list[str]]:
        groups: dict[str, list[str]] = defaultdict(list)
        for item in self.parent:
            groups[self.find(item)].append(item)
        return [sorted(g) for g in groups.values() if len(g) > 1]


@lru_cache(maxsize=None)
def script_of(letter: str) -> str | None:
    """The script of a letter when it is one that look-alikes are known for."""
    if not letter.isalpha():
        return None
    name = unicodedata.name(letter, "").split(" ")[0].capitalize()
    return name if name in SCRIPTS else None


_CLASSES: list[tuple[tuple[str, ...], ...]] = []


def lookalike_classes(spark: SparkSession) -> tuple[tuple[str, ...], ...]:
    """The look-alike classes over letters of :data:`SCRIPTS`, read once from the confusables data on Spark's class path."""
    if not _CLASSES:
        letters = [c for c in map(chr, range(0x41, 0x1F000)) if script_of(c) and unicodedata.normalize("NFKC", c) == c == unicodedata.normalize("NFD", c)]
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        sets = UnionFind()
        for letter, skeleton in zip(letters, checker.getSkeleton("\n".join(letters)).split("\n")):
            sets.union(letter, skeleton)
        for a, b in ALSO_ALIKE:
            sets.union(a, b)
        known = set(letters)
        made = ([c for c in group if c in known] for group in sets.classes())
        _CLASSES.append(tuple(tuple(c) for c in sorted(made) if len(c) > 1))
    return _CLASSES[0]


@lru_cache(maxsize=1)
def form_rewrites() -> dict[str, str]:
    """Every string that is not in its plain composed form, with that form; union-find joins chains of forms."""
    sets, plain = UnionFind(), {}
    invisible = {}
    for point in range(0x80, sys.maxunicode + 1):
        c = chr(point)
        kind = unicodedata.category(c)
        if kind in ("Cf", "Cc") or c in BLANKS or 0xFE00 <= point <= 0xFE0F or 0xE0100 <= point <= 0xE01EF:
            if c != "\x85":
                invisible[c] = ""
            continue
        if kind in ("Cn", "Co", "Cs") or 0xAC00 <= point <= 0xD7A3 or 0x3131 <= point <= 0x318E:
            continue
        if kind in ("Zs", "Zl", "Zp"):
            invisible[c] = " "
            continue
        if kind[0] not in "LNM" or c in ORDINARY:
            continue
        target = unicodedata.normalize("NFKC", c)
        if unicodedata.decomposition(c).startswith("<fraction>"):
            continue
        apart = unicodedata.normalize("NFD", c)
        if target != c:
            sets.union(c, target)
            plain[target] = target
        elif apart != c:
            sets.union(apart, c)
            plain[c] = c
    for point in [*range(0x00, 0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F]:
        invisible[chr(point)] = ""
    rewrites = dict(invisible)
    for members in sets.classes():
        best = next((m for m in sorted(members, key=lambda m: (len(m), m)) if m in plain and unicodedata.normalize("NFKC", m) == m), None)
        if best is not None:
            rewrites |= {m: best for m in members if m != best}
    return rewrites


def _machine(rewrites: dict):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for text, target in rewrites.items():
        machine.add_word(text, (len(text), target))
    machine.make_automaton()
    return machine


def _rewritten(text: str, machine, target=lambda found: found) -> str:
    """``text`` with every match of ``machine`` rewritten, longest first; matches whose target is None are kept."""
    out, at = [], 0
    for end, (size, found) in machine.iter_long(text):
        new = target(found)
        if new is not None:
            out.append(text[at : end - size + 1])
            out.append(new)
            at = end + 1
    return "".join(out) + text[at:] if at else text


@lru_cache(maxsize=1)
def _forms():
    return _machine(form_rewrites())


def plain_form(text: str) -> str:
    """``text`` with every form rewritten, longest match first, and marks composed."""
    return text if text.isascii() and text.isprintable() else unicodedata.normalize("NFC", _rewritten(text, _forms()))


def _ordinary(letter: str) -> bool:
    first, end = ORDINARY_BLOCKS[script_of(letter)]
    return first <= ord(letter) < end


class Rewriter:
    """Rewrites look-alike letters by the representatives that a corpus' letter counts give."""

    def __init__(self, counts: dict[str, int], classes: tuple[tuple[str, ...], ...]) -> None:
        self.common = Counter({s: 0 for s in SCRIPTS})
        for letter, n in counts.items():
            if script := script_of(letter):
                self.common[script] += n
        self.member: dict[str, dict[str, str]] = {}
        phonetic: dict[str, str] = {}
        for group in classes:
            best: dict[tuple[str, bool], str] = {}
            for letter in sorted(filter(_ordinary, group), key=lambda c: (-counts.get(c, 0), c)):
                best.setdefault((script_of(letter), letter.isupper()), letter)
            for letter in group:
                self.member[letter] = {script: c for (script, upper), c in best.items() if upper == letter.isupper()}
                if any(first <= ord(letter) < end for first, end in PHONETIC_BLOCKS) and script_of(letter) in self.member[letter]:
                    phonetic[letter] = self.member[letter][script_of(letter)]
        self.phonetic = _machine(phonetic) if phonetic else None
        self.letters = _machine({letter: letter for letter in self.member}) if self.member else None

    def word(self, word: str) -> str:
        """``word`` in one script if it mixes look-alike scripts: the script that most of its letters can be written in."""
        scripts = {s for c in word if (s := script_of(c))}
        if len(scripts) < 2:
            return word
        apart = unicodedata.normalize("NFD", word)
        own, foreign = Counter(), Counter()
        for c in apart:
            if s := script_of(c):
                own[s] += 1
                for other in scripts - {s}:
                    foreign[other] += other not in self.member.get(c, ())
        target = max(sorted(scripts), key=lambda s: (-foreign[s], own[s], self.common[s]))
        return unicodedata.normalize("NFC", _rewritten(apart, self.letters, lambda c: None if script_of(c) == target else self.member[c].get(target)))

    def text(self, text: str) -> str:
        return self.read(text)[0]

    def read(self, text: str) -> tuple[str, bool]:
        """The consistent form of ``text`` and whether it has words that mix scripts, put right or not."""
        plain = plain_form(text)
        if plain.isascii():
            return plain, False
        if self.phonetic:
            plain = _rewritten(plain, self.phonetic)
        out, word, mixed = [], [], False
        for c in [*plain, " "]:
            if c.isalnum() or unicodedata.category(c)[0] == "M":
                word.append(c)
                continue
            if word:
                whole = "".join(word)
                mixed |= len({s for x in whole if (s := script_of(x))}) > 1
                out.append(self.word(whole))
                word = []
            out.append(c)
        return "".join(out)[:-1], mixed


Counts = tuple[tuple[str, int], ...]
Classes = tuple[tuple[str, ...], ...]
_REWRITERS: dict[tuple, Rewriter] = {}


def rewriter(counts: Counts, classes: Classes) -> Rewriter:
    """The rewriter of these counts, built once a process."""
    if (counts, classes) not in _REWRITERS:
        _REWRITERS.clear()
        _REWRITERS[counts, classes] = Rewriter(dict(counts), classes)
    return _REWRITERS[counts, classes]


def letter_counts(texts: DataFrame, text: str) -> Counts:
    """How often the corpus uses each letter of a look-alike class.

    Counted over all rows: each Arrow batch gives one row a letter, sums are combined before the shuffle; what is gathered is
    bounded by the members of the classes (under 1,000).
    """
    letters = frozenset(c for group in lookalike_classes(texts.sparkSession) for c in group)

    def count(batches):
        for batch in batches:
            found = Counter("".join(batch["t"]))
            rows = [(c, n) for c, n in found.items() if c in letters]
            yield pd.DataFrame({"c": [c for c, _ in rows], "n": [n for _, n in rows]})

    known = texts.select(F.col(text).alias("t")).where("t is not null")
    found = known.mapInPandas(count, "c string, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    return tuple(sorted((r.c, r.n) for r in found.collect()))


def consistent(text: Column, counts: Counts, classes: Classes) -> Column:
    """STRUCT<plain, mixed>: the consistent form of ``text`` and whether words in it mix scripts; null stays null, empty stays empty."""

    @F.pandas_udf("plain string, mixed boolean")
    def rewrite(values: pd.Series) -> pd.DataFrame:
        make = rewriter(counts, classes).read
        seen: dict[str | None, tuple[str | None, bool]] = {None: (None, False)}
        rows = [seen[v] if v in seen else seen.setdefault(v, make(v)) for v in values]
        return pd.DataFrame(rows, columns=["plain", "mixed"])

    return rewrite(text)


def consistent_texts(texts: DataFrame, text: str, out: str = "plain", counts: Counts | None = None) -> DataFrame:
    """``texts`` with ``out``: the consistent form of ``text``.

    Changed are: letters, digits and spaces in another than their plain composed form, invisible characters (dropped), and
    look-alike letters in words that mix look-alike scripts. Kept are: words wholly in one script, composed accents, dashes,
    quotes and other punctuation, letter case, tabs and repeated plain spaces. Null gives null and empty text empty text;
    texts of any length are rewritten whole; repeated rows and extra columns stay (a column named ``out`` is replaced).

    Rows whose text is plain by a JVM test are not sent to Python. No shuffle of rows; only the letter counts are gathered.
    """
    counts = letter_counts(texts, text) if counts is None else counts
    kept = [c for c in texts.columns if c != out]
    odd = texts.where(F.col(text).rlike(SUSPECT))
    plain = texts.where(~F.coalesce(F.col(text).rlike(SUSPECT), F.lit(False)))
    return plain.select(*kept, F.col(text).alias(out)).unionByName(odd.select(*kept, consistent(F.col(text), counts, lookalike_classes(texts.sparkSession))["plain"].alias(out)))


def odd_texts(texts: DataFrame, text: str, counts: Counts | None = None) -> DataFrame:
    """The rows of ``texts`` whose text is not in its consistent form, with ``plain``; see :func:`consistent_texts`.

    A text with a word that mixes look-alike scripts is not in it even where no representative can put the word right.
    """
    counts = letter_counts(texts, text) if counts is None else counts
    odd = texts.where(F.col(text).rlike(SUSPECT))
    row = F.struct(*[F.col(f"`{c}`") for c in texts.columns if c != "plain"]).alias("_row")
    told = odd.select(row, F.col(text).alias("_text"), consistent(F.col(text), counts, lookalike_classes(texts.sparkSession)).alias("_told"))
    return told.where((F.col("_text") != F.col("_told.plain")) | F.col("_told.mixed")).select("_row.*", "_told.plain")
