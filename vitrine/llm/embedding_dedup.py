"""Near-duplicate embeddings by a robust-pruned flat graph.

1. Exact copies of a vector are one node. Nodes are dealt to overlapping cluster shards: k-means on a bounded sample of
   each shard that is still too large (`SAMPLE` vectors), every node goes to its nearest centroid and to the second
   nearest if that is about as near. Shards that are one tight clump are not split.
2. In each shard (in bounded blocks of it, every two of which meet) a graph is built: near neighbours and some far ones,
   thinned by robust pruning, with the edges back.
3. The adjacency lists of a node from all its shards are united.
4. In each shard, every node searches the united graph greedily from spread-out medoids; hits within the range are then
   expanded until no node next to a hit is left unseen.
5. Hits are verified by cosine in double precision. Each pair counts in one meeting only (its parts', in the first shard
   that both share). Links leave a task as counts and one star per connected part, never as pairs.

`audit` measures recall against brute force for the vectors whose id is divisible by 50.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors without an id,
link with nothing: 0 links, their own component, kept. Vectors of different lengths do not link. Repeated rows are copies
and link with one another; rows that share an id but not the vector have their links added up. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import SEED, connected, meetings, stars
from vitrine.session import measured, stored

SAMPLE = 2000
BLOCK = 1000
SPREAD = 256  # centroids of one split
LEVELS = 6
NEAR_POOL, NEAR, FAR_POOL, FAR, ALPHA = 64, 16, 16, 6, 1.2
BEAM, MEDOIDS, DEGREE = 24, 32, 64
EDGE = 0.1  # how much farther (in cosine) the second centroid may be


def unit(vectors: list) -> np.ndarray:
    """Rows scaled to unit length in double precision, safe for the largest and smallest floats."""
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(node, v, copies, shard): the distinct vectors that can link, under the smallest id that has them."""
    v = F.col(embedding).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = F.col(vec_id).isNotNull() & F.coalesce(~bad & F.exists(v, lambda c: c != 0), F.lit(False))
    return (vectors.filter(fine).groupBy(v.alias("v")).agg(F.min(vec_id).cast("long").alias("node"), F.count("*").alias("copies"))
            .select("node", "v", "copies", F.size("v").cast("string").alias("shard")))


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, a few rounds from seeded random members."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def shards(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """(shard, node): overlapping shards of about `block` nodes; only tight clumps stay larger."""
    members, vectors = found.select("shard", "node"), found.select("node", "v")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, centres = [], []
            for name, n, sample in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                x = unit(sample.as_py())
                middle = x.mean(axis=0)
                if (x @ middle).mean() / max(np.linalg.norm(middle), 1e-12) < 0.9:
                    shard.append(name)
                    centres.append(_centroids(x, min(SPREAD, -(-2 * n // block))).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.string()), pa.array(centres, pa.list_(pa.list_(pa.float64())))], names=["shard", "centres"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, node = [], []
            for name, group, centres in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                own = group.as_py()
                near = unit([m["v"] for m in own]) @ np.array(centres.as_py()).T
                order = np.argsort(-near, axis=1)[:, :2]
                for m, places, likeness in zip(own, order.tolist(), np.take_along_axis(near, order, axis=1).tolist()):
                    for place, like in zip(places, likeness):
                        if like >= likeness[0] - EDGE:
                            shard.append(f"{name}.{place}")
                            node.append(m["node"])
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.string()), pa.array(node, pa.int64())], names=["shard", "node"])

    for level in range(LEVELS):
        large = members.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > block)
        taken = F.pmod(F.xxhash64(F.lit(level), "node"), F.lit(1 << 20)) < F.lit(SAMPLE << 20) / F.col("n")
        sample = members.join(large, "shard").filter(taken).join(vectors, "node").groupBy("shard", "n").agg(F.collect_list("v").alias("sample"))
        cut, seen = measured(sample.mapInArrow(split, "shard string, centres array<array<double>>"), "centres", F.count("*").alias("n"))
        if not seen["n"]:
            break
        whole_ = members.join(cut, "shard", "left_anti")
        dealt = members.join(large, "shard").join(cut.select("shard"), "shard", "left_semi").join(vectors, "node").groupBy(
            "shard", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / 2000)).alias("part")).agg(F.collect_list(F.struct("node", "v")).alias("group"))
        moved = dealt.join(cut, "shard").select("shard", "group", "centres").mapInArrow(assign, "shard string, node long")
        members = stored(whole_.unionByName(moved), "shards")
    return members


def robust_graph(x: np.ndarray) -> list[list[int]]:
    """Adjacency lists of unit vectors: robust-pruned near and far neighbours, with the edges back."""
    n = len(x)
    if n <= 2:
        return [[j for j in range(n) if j != i] for i in range(n)]
    like = (x @ x.T).astype(np.float32)
    np.fill_diagonal(like, -2)
    near = np.argpartition(-like, min(NEAR_POOL, n - 1) - 1, axis=1)[:, :min(NEAR_POOL, n - 1)]
    far = np.random.default_rng(SEED).integers(0, n, (n, min(FAR_POOL, n - 1)))
    edges: list[set[int]] = [set() for _ in range(n)]
    row = np.arange(n)
    for pool, most in ((near, NEAR), (far, FAR)):
        pool = np.take_along_axis(pool, np.argsort(-like[row[:, None], pool], axis=1), axis=1)
        away = np.maximum(1 - like[row[:, None], pool], 0)
        alive = pool != row[:, None]
        for _ in range(most):
            at = alive.argmax(axis=1)
            ok = alive[row, at]
            if not ok.any():
                break
            chosen = pool[row, at]
            for i, j in zip(row[ok].tolist(), chosen[ok].tolist()):
                edges[i].add(j)
                edges[j].add(i)
            between = np.maximum(1 - like[chosen[:, None], pool], 0)
            between[chosen[:, None] == pool] = 0
            alive &= (ALPHA * between > away) & ok[:, None]
            alive[row, at] = False
    return [sorted(e) for e in edges]


def _medoids(x: np.ndarray) -> np.ndarray:
    """Spread-out starting points: the vector nearest the middle, then always the one farthest from those chosen."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(MEDOIDS, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return np.array(chosen)


def range_search(x: np.ndarray, adjacency: list[list[int]], least: float) -> np.ndarray:
    """For every vector as query the vectors found with cosine >= `least`, as a boolean matrix (found either way)."""
    n, single = len(x), x.astype(np.float32)
    degree = max(1, max(len(a) for a in adjacency))
    table = np.full((n, degree), -1, np.int64)
    for i, a in enumerate(adjacency):
        table[i, :len(a)] = a
    seen, hit = np.zeros((n, n), bool), np.zeros((n, n), bool)
    row = np.arange(n)
    limit = least - 1e-4  # single precision; verified below

    def look(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.concatenate([np.einsum("ij,ij->i", single[queries[a:a + 65536]], single[others[a:a + 65536]])
                               for a in range(0, len(queries), 65536)] or [np.empty(0, np.float32)])

    start = _medoids(x)
    beam = np.tile(start, (n, 1))
    likeness = single @ single[start].T
    seen[:, start] = True
    hit[:, start] = likeness >= limit
    done = np.zeros(beam.shape, bool)
    while True:
        best = np.where(done, -2, likeness)
        at = best.argmax(axis=1)
        active = np.flatnonzero(best[row, at] > -2)
        if not len(active):
            break
        done[active, at[active]] = True
        around = table[beam[active, at[active]]]
        fresh = (around >= 0) & ~seen[active[:, None], around]
        who, place = np.nonzero(fresh)
        other = around[who, place]
        values = np.full(around.shape, -2, np.float32)
        values[who, place] = found = look(active[who], other)
        seen[active[who], other] = True
        hit[active[who], other] = found >= limit
        grown = np.full((n, around.shape[1]), -2, np.float32)
        grown[active] = values
        ids = np.zeros((n, around.shape[1]), np.int64)
        ids[active] = around
        beam, likeness = np.hstack([beam, ids]), np.hstack([likeness, grown])
        done = np.hstack([done, grown == -2])
        if beam.shape[1] > BEAM:
            keep = np.argpartition(-likeness, BEAM - 1, axis=1)[:, :BEAM]
            beam, likeness, done = (np.take_along_axis(m, keep, axis=1) for m in (beam, likeness, done))
    links = np.zeros((n, n), np.float32)
    links[np.repeat(row, [len(a) for a in adjacency]), [j for a in adjacency for j in a]] = 1
    edge = hit.copy()
    while edge.any():  # range expansion: all that stands next to a hit
        queries = np.flatnonzero(edge.any(axis=1))
        next_ = (edge[queries].astype(np.float32) @ links > 0) & ~seen[queries]
        who, other = np.nonzero(next_)
        seen[queries[who], other] = True
        found = look(queries[who], other) >= limit
        edge = np.zeros((n, n), bool)
        edge[queries[who[found]], other[found]] = True
        hit |= edge
    a, b = np.nonzero(np.triu(hit | hit.T, 1))
    true = np.concatenate([np.einsum("ij,ij->i", x[a[i:i + 65536]], x[b[i:i + 65536]]) for i in range(0, len(a), 65536)] or [np.empty(0)]) >= least
    linked = np.zeros((n, n), bool)
    linked[a[true], b[true]] = linked[b[true], a[true]] = True
    return linked


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, around = [], []
        for group in batch.column(0):
            own = group.as_py()
            ids = [m["node"] for m in own]
            for i, a in zip(ids, robust_graph(unit([m["v"] for m in own]))):
                node.append(i)
                around.append([ids[j] for j in a])
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(around, pa.list_(pa.int64()))], names=["node", "around"])


def links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95,
          block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (node, v, copies, shard), and per meeting and node with links (node, other, n_links): how many
    vectors it links to there, and another node of its connected part."""
    found = stored(nodes(vectors, vec_id, embedding), "nodes")
    members = stored(shards(found, block), "members")
    met = meetings(members, "shard", "node", found.select("node", "v"), block).select("group")
    graph = met.mapInArrow(_build, "node long, around array<long>")
    union = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("around"))).alias("around"))
    homes = members.groupBy("node").agg(F.sort_array(F.collect_set("shard")).alias("homes"))
    payload = stored(found.select("node", "v", "copies").join(union, "node").join(homes, "node"), "graph")
    met = meetings(members, "shard", "node", payload, block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, other, counts = [], [], []
            for shard, across, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = group.as_py()
                ids = [m["node"] for m in own]
                place = {i: k for k, i in enumerate(ids)}
                around = [[place[j] for j in m["around"] if j in place] for m in own]
                linked = range_search(unit([m["v"] for m in own]), around, least)
                part, copies = np.array([m["of_part"] for m in own]), np.array([m["copies"] for m in own])
                label, counted = stars(linked), linked
                if across:
                    counted = counted & (part[:, None] != part[None, :])
                # Pairs that also share an earlier shard are counted there.
                names = {s: k for k, s in enumerate(sorted({h for m in own for h in m["homes"] if h < shard}))}
                if names:
                    early = np.zeros((len(own), len(names)), np.float32)
                    for k, m in enumerate(own):
                        early[k, [names[h] for h in m["homes"] if h < shard]] = 1
                    counted = counted & (early @ early.T == 0)
                total = counted @ copies
                for k in np.flatnonzero(linked.any(axis=1)).tolist():
                    node.append(ids[k])
                    other.append(ids[label[k]])
                    counts.append(int(total[k]))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(counts, pa.int64())], names=["node", "other", "n_links"])
    return found, stored(met.mapInArrow(search, "node long, other long, n_links long"), "links")


def groups(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id of its component), kept."""
    found, linked = links(vectors, vec_id, embedding, least)
    counts = linked.groupBy("node").agg(F.sum("n_links").alias("far"))
    roots = connected(linked.select(F.col("node").alias("a"), F.col("other").alias("b")))
    smallest = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    named = roots.join(smallest, "root").select("node", "component_id")
    known = (found.join(counts, "node", "left").join(named, "node", "left").select(
        "v", (F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component_id", "node").alias("component")))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(F.col(vec_id).isNotNull(), F.col(embedding).cast("array<double>")).alias("own"))
    return rows.join(known, F.col("own") == F.col("v"), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").cast("long").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))


def audit(vectors: DataFrame, result: DataFrame, least: float = 0.95, modulo: int = 50) -> float:
    """Recall of `groups`: links found over true links, for the vectors whose id is divisible by `modulo`, by brute
    force against all vectors in blocks of queries."""
    rows = stored(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).dropna(), "audit")
    asked = rows.filter(F.col("vec_id") % modulo == 0).withColumn("pack", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    packs = asked.groupBy("pack").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for queries, others in zip(batch.column(0), batch.column(1)):
                own, rest = queries.as_py(), others.as_py()
                like = unit([q["v"] for q in own]) @ unit([o["v"] for o in rest]).T
                same = np.array([q["vec_id"] for q in own])[:, None] == np.array([o["vec_id"] for o in rest])[None, :]
                ids += [q["vec_id"] for q in own]
                counts += ((like >= least) & ~same).sum(axis=1).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], names=["vec_id", "n"])
    blocks = rows.groupBy(F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(64)).alias("block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("others"))
    true = packs.crossJoin(blocks).select("queries", "others").mapInArrow(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    both = true.join(result.select("vec_id", "n_links"), "vec_id").agg(F.sum("n").alias("n"), F.sum("n_links").alias("found")).first()
    return both["found"] / both["n"] if both["n"] else 1.0
