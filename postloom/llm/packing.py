"""Filling packs of fixed capacity with documents: bound-certified repacking.

Documents are spread over partitions of bounded size and packed there by best-fit decreasing. Dual-feasible functions give a lower
bound of the packs that a partition needs; where the count meets the bound the partition is certified and left alone. Partitions
with a gap hand over the documents of their loose packs, which are exchanged between partitions and packed again; a repacking
counts only if it needs fewer packs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.session import checkpoint_ready

#: Documents of one partition.
PART = 20_000


def lower_bound(sizes: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """A number of packs that no packing of ``sizes`` (each at most ``capacity``) can go below, by dual-feasible functions.

    With ``counts`` the sizes are distinct and stand for so many pieces each.
    """
    if not len(sizes):
        return 0
    if counts is None:
        values, counts = np.unique(np.asarray(sizes, dtype=np.int64), return_counts=True)
    else:
        values, counts = np.asarray(sizes, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    best = math.ceil(int((values * counts).sum()) / capacity)
    for k in range(1, 21):  # u(k): x where (k+1)x is whole, else floor((k+1)x)/k
        scaled = (k + 1) * values
        units = np.where(scaled % capacity == 0, k * values, (scaled // capacity) * capacity)
        best = max(best, -(-int((units * counts).sum()) // (k * capacity)))
    for small in np.unique(np.concatenate([values[values <= capacity // 2], [0]])):  # U(e): large ones count whole, small ones nothing
        worth = np.where(values > capacity - small, capacity, np.where(values < small, 0, values))
        best = max(best, -(-int((worth * counts).sum()) // capacity))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The pack number of each size by best-fit decreasing; ties keep their order."""
    open_by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r set: a pack with room r is open
    packs = np.empty(len(sizes), dtype=np.int64)
    n = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = open_by_room[room]
            pack = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, pack = capacity, n
            n += 1
        packs[i] = pack
        if left := room - size:
            open_by_room.setdefault(left, []).append(pack)
            rooms |= 1 << left
    return packs


_KIND = "pack_name string, capacity_tokens bigint, id bigint, size bigint, part string, pack string, load bigint, gap boolean, turn int"


def _filled(frame: pd.DataFrame, part: str, turn: int) -> pd.DataFrame:
    sizes, capacity = frame["size"].to_numpy(), int(frame["capacity_tokens"].iloc[0])
    packs = best_fit(sizes, capacity)
    loads = np.bincount(packs, weights=sizes).astype(np.int64)
    gap = len(loads) > lower_bound(sizes, capacity)
    names = np.array([f"{part}-{k}" for k in range(len(loads))], dtype=object)
    return frame.assign(part=part, pack=names[packs], load=loads[packs], gap=gap, turn=turn)[[c.split()[0] for c in _KIND.split(", ")]]


def _again(frame: pd.DataFrame, turn: int) -> pd.DataFrame:
    """The packs of partitions with a gap packed anew together; the old packs stay where that needs no fewer."""
    frame = frame.sort_values("id")
    new = _filled(frame, f"{turn}-{frame['meet'].iloc[0]}", turn)
    if new["pack"].nunique() < frame["pack"].nunique():
        return new
    return frame.assign(gap=new["gap"].to_numpy())[new.columns]


def pack_documents(
    sizes: DataFrame, packs: list[tuple[str, int]], *, key: str = "doc_id", part: int = PART
) -> DataFrame:
    """(``pack_name``, ``key``, ``piece_no``, ``from_token``, ``to_token``, ``pack_id``, ``part``, ``certified``): where every document goes, for every pack size.

    ``sizes`` has a unique bigint ``key`` and ``tokens``. A document is one piece unless it alone exceeds the capacity; then
    it is cut into full packs of its own and a rest, which is packed like any document. Documents without tokens (null or not
    positive) are in no pack; empty input gives no rows; equal sizes keep the order of their keys; extra columns are ignored.
    Capacities below 1 are refused.

    ``part`` is the partition that a pack was filled in, ``certified`` whether that partition met its lower bound (packs full by
    themselves are). Partitions with a gap hand over their packs that are not full; these meet by chance in groups of about ``part``
    documents and are packed again, until every one is certified or a round gains nothing. Each partition and group holds about
    ``part`` documents whatever the total, so no task grows with the input.
    """
    if any(capacity < 1 for _, capacity in packs):
        raise ValueError("capacities must be positive")
    checkpoint_ready(sizes.sparkSession)
    names = F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(int(c)).cast("bigint").alias("capacity_tokens")) for n, c in packs])
    known = sizes.select(F.col(key).alias("id"), "tokens").where("tokens > 0").checkpoint()
    parts = max(1, math.ceil(known.count() / part))
    every = known.select("id", "tokens", F.explode(names).alias("p")).select("id", "tokens", "p.*")
    every = every.withColumn("whole", F.floor(F.col("tokens") / F.col("capacity_tokens"))).withColumn("size", F.col("tokens") % F.col("capacity_tokens"))
    cut = every.where("whole > 0").select("pack_name", "id", F.explode(F.sequence(F.lit(1), F.col("whole"))).alias("piece_no"), "capacity_tokens")
    cut = cut.select(
        "pack_name",
        "id",
        F.col("piece_no").cast("int").alias("piece_no"),
        ((F.col("piece_no") - 1) * F.col("capacity_tokens")).alias("from_token"),
        (F.col("piece_no") * F.col("capacity_tokens")).alias("to_token"),
        F.concat_ws("-", F.lit("cut"), F.col("id").cast("string"), F.col("piece_no").cast("string")).alias("pack_id"),
        F.lit("cut").alias("part"),
        F.lit(True).alias("certified"),
    )
    items = every.where("size > 0").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        return _filled(frame.sort_values("id"), f"0-{frame['part'].iloc[0]}", 0)

    packed = items.select("pack_name", "capacity_tokens", "id", "size", "part").groupBy("pack_name", "part").applyInPandas(first, _KIND).checkpoint()
    turn = 0
    while True:
        loose = F.col("gap") & (F.col("load") < F.col("capacity_tokens"))
        # A count for each pack size: as many groups as keep to ``part`` documents.
        amounts = {r.pack_name: max(1, math.ceil(r["count"] / part)) for r in packed.where(loose).groupBy("pack_name").count().collect()}
        if not amounts:
            break
        turn += 1
        groups = F.create_map(*[F.lit(x) for pair in amounts.items() for x in pair])[F.col("pack_name")]
        given = packed.where(loose).withColumn("meet", F.pmod(F.xxhash64("pack", F.lit(turn)), groups))
        now = turn
        anew = given.groupBy("pack_name", "meet").applyInPandas(lambda f: _again(f, now), _KIND)
        packed = packed.where(~loose).unionByName(anew).checkpoint()
        if packed.where(F.col("turn") == turn).isEmpty():
            break
    rest = packed.join(every.select("pack_name", F.col("id"), "whole", "tokens"), ["pack_name", "id"]).select(
        "pack_name",
        "id",
        (F.col("whole") + 1).cast("int").alias("piece_no"),
        (F.col("tokens") - F.col("size")).alias("from_token"),
        F.col("tokens").alias("to_token"),
        F.col("pack").alias("pack_id"),
        "part",
        (~F.col("gap")).alias("certified"),
    )
    return cut.unionByName(rest).withColumnRenamed("id", key)


def pack_report(packed: DataFrame, packs: list[tuple[str, int]]) -> DataFrame:
    """(``pack_name``, ``capacity_tokens``, ``n_packs``, ``lower_bound``, ``n_tokens``, ``filled``): how close a packing comes to the bound.

    The bound is taken over the sizes of all pieces, whose histogram has at most ``capacity_tokens`` rows a pack size.
    """
    spark = packed.sparkSession
    pieces = packed.select("pack_name", "pack_id", (F.col("to_token") - F.col("from_token")).alias("size"))
    totals = {r.pack_name: r for r in pieces.groupBy("pack_name").agg(F.count_distinct("pack_id").alias("n"), F.sum("size").alias("t")).collect()}
    sizes = pieces.groupBy("pack_name", "size").count().collect()
    rows = []
    for name, capacity in packs:
        held = [(r["size"], r["count"]) for r in sizes if r.pack_name == name]
        bound = lower_bound(np.array([s for s, _ in held]), capacity, np.array([n for _, n in held])) if held else 0
        n, tokens = (totals[name].n, totals[name].t) if name in totals else (0, 0)
        rows.append((name, capacity, n, bound, tokens, tokens / (n * capacity) if n else None))
    return spark.createDataFrame(rows, "pack_name string, capacity_tokens int, n_packs bigint, lower_bound bigint, n_tokens bigint, filled double")


def part_report(packed: DataFrame) -> DataFrame:
    """(``pack_name``, ``part``, ``n_packs``, ``n_tokens``, ``certified``) of every partition that packs were filled in."""
    pieces = packed.select("pack_name", "part", "pack_id", (F.col("to_token") - F.col("from_token")).alias("size"), "certified")
    sums = pieces.groupBy("pack_name", "part", "pack_id").agg(F.sum("size").alias("t"), F.min("certified").alias("c"))
    return sums.groupBy("pack_name", "part").agg(F.count("*").alias("n_packs"), F.sum("t").alias("n_tokens"), F.min("c").alias("certified"))
