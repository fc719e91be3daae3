"""Shared helpers: document identity, connected components, bounded comparison groups, SimHash."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.session import measured, stored

SEED = 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: str = "text") -> Column:
    """Tells apart rows that carry one id but different texts; repeated rows share it."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def whole(docs: DataFrame) -> Column:
    """All columns of a row as one struct `row`, so that no name of theirs meets a name of ours; unpack with `row.*`."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of `edges` (a, b): one row (node, root) for every node of an edge between two nodes.

    Contraction: each round maps every node to the first of its neighbourhood in a hashed order, then keeps the edges
    between different images. The edges shrink geometrically, chains included; each round's edges and map are tables in
    the shared folder, so a lost executor costs one stage. `root` is any node of the component, the same for all its
    nodes. Self-loops, nulls and repeated edges do no harm; without edges the result is empty.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("r"), F.col(c).alias("v"))
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    live, seen = measured(edges.dropna().filter("a <> b").select(a, b).distinct(), "edges", F.count("*").alias("n"))
    maps: list[DataFrame] = []
    while seen["n"] or not maps:
        both = live.union(live.select("b", "a")).toDF("node", "other")
        nearest = both.groupBy("node").agg(F.min(rank("other")).alias("m"))
        image = stored(nearest.select("node", F.least("m", rank("node"))["v"].alias("root")), "image")
        maps.append(image)
        moved = (live.join(image.toDF("a", "ra"), "a").join(image.toDF("b", "rb"), "b").filter("ra <> rb")
                 .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        live, seen = measured(moved, "edges", F.count("*").alias("n"))
    labels = maps.pop()
    while maps:
        last = labels.toDF("root", "last")
        labels = maps.pop().join(last, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return stored(labels, "components")


def meetings(members: DataFrame, key: str, member: str, payload: DataFrame | None = None, block: int = 512) -> DataFrame:
    """Bring members with the same key together in groups of bounded size.

    `members` has one row per `key` and `member`; `payload` adds columns to a member, once company is found. A key
    with more than `block` members is dealt into parts by a hash of the member, and every two parts of it meet in one
    row, on whichever executor that row hashes to: no row holds more than about two blocks, no pair of members is
    missed, and no pairs of members are materialised. Members without company are dropped.
    Returns one row per meeting: `key`, `across` (the members are of two parts; those of one part meet elsewhere, too)
    and `group`, an array of structs (member, `of_part`, payload columns).
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    together = members.join(sizes, key)
    together = together.join(payload, member) if payload is not None else together
    carried = [member, *(c for c in (payload.columns if payload is not None else ()) if c != member)]
    dealt = (together.withColumn("_parts", F.ceil(F.col("_n") / block).cast("int"))
             .withColumn("_part", F.pmod(F.xxhash64(F.lit("part"), member), "_parts").cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))))
    return (dealt.groupBy(key, F.least("_part", "_other").alias("_lo"), F.greatest("_part", "_other").alias("_hi"))
            .agg(F.collect_list(F.struct(*carried, F.col("_part").alias("of_part"))).alias("group"))
            .filter(F.size("group") > 1).select(key, (F.col("_lo") != F.col("_hi")).alias("across"), "group"))


def stars(linked: np.ndarray) -> np.ndarray:
    """Component label (smallest index) of every vertex of a symmetric boolean adjacency matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        best = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1))
        best = best[best]
        if (best == label).all():
            return label
        label = best


def majority_bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash words of consecutive runs of 64-bit hashes, as uint64: bit i is 1 if set in over half of a run.

    `starts` are the first positions of the runs, none of them empty. Extra leading axes of `hashes` are lanes.
    """
    runs = np.diff(np.append(starts, hashes.shape[-1]))
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(*hashes.shape, 8), axis=-1)
    # Eight one-byte counters at a time in a 64-bit word, which hold for up to 255 hashes; longer runs go in pieces.
    starts = np.asarray(starts)
    pieces = np.concatenate([np.arange(a, a + n, 255) for a, n in zip(starts.tolist(), runs.tolist())]) if (runs > 255).any() else starts
    ones = np.add.reduceat(bits.view(np.uint64), pieces, axis=-2).view(np.uint8)
    if len(pieces) > len(starts):
        ones = np.add.reduceat(ones, np.searchsorted(pieces, starts), axis=-2, dtype=np.int32)
    else:
        ones = ones.astype(np.int32)
    return np.packbits(ones * 2 > runs[:, None], axis=-1).view(np.uint64)[..., 0]


def in_chunks(sizes: list[int], most: int) -> list[slice]:
    """Consecutive slices of a list whose sizes add up to about `most` each, a larger single item on its own."""
    cuts, start, total = [], 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            cuts.append(slice(start, i))
            start, total = i, 0
        total += n
    return [*cuts, slice(start, len(sizes))] if sizes else []

