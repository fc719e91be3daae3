"""SimHash near-duplicates: pigeonhole blocks, Hamming verification, connected groups.

Two forms share the machinery:

* `groups`: 64-bit fingerprints of word shingles, linked at a few differing bits (the contract of the query).
  Fingerprints are split into `bits + 2` blocks; two fingerprints within `bits` differing bits agree on at least two
  whole blocks, so every pair of blocks is a join key. The search is exact: no link is lost.
* `near_copies`: documents whose five-word shingle sets have a Jaccard similarity of about 0.8 or more. There about
  15 % of SimHash bits differ, which no split of 64 bits into blocks can serve. The fingerprint therefore has
  `sections`: shingles are dealt to sections by their hash, a section is the SimHash of the few shingles in it, and
  close documents share whole sections (pigeonhole on the shingles that differ). Texts of up to `SHORT` shingles have
  exact keys instead: in any fixed order of all shingles, two sets at a Jaccard similarity of 0.8 share one of the first
  n - ceil(0.8 n) + 1 of each. Candidates pass a loose
  Hamming filter over a 1024-bit fingerprint of all shingles; the exact Jaccard similarity of the shingles decides.

Exact copies are one fingerprint; groups of any size are compared in bounded blocks (`common.meetings`).

Defined results: a null text has no words; no words give fingerprint zero, in `groups` linked like any other, in
`near_copies` linked with nothing. Fewer words than a shingle form one shingle. Null ids stay as rows; the smallest
non-null id names a group. Repeated rows are rows of one document. Other columns are ignored by the analysis and pass
through `keep_one`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import SEED, connected, majority_bits, meetings, stars, text_key, whole
from vitrine.session import stored

#: A section holds this many shingles on average, at most twice as many.
SECTION_SHINGLES = 5
LANES = 16
LANE_FACTORS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) & (1 << 64) - 1 for i in range(LANES)], np.uint64)
SECTIONS = 16
#: Bits of 1024 that differ at a Jaccard similarity of just under 0.8: the cosine is 2J / (1 + J), the share of bits its
#: angle / pi, and the estimate scatters by a hundredth.
NEAR_BITS = 164
#: The filter before the exact Jaccard similarity: three standard deviations above what differs at 0.8.
LOOSE_BITS = 190
#: The same where a text is short, whose fingerprint scatters more.
LOOSE_BITS_SHORT = 320
#: Texts of fewer than SECTIONED shingles have exact keys only; their near copies have SHORT shingles at most.
SECTIONED = 100
SHORT = 125
LEAST = 0.8
HASHES_AT_ONCE = 1 << 16
ALL_BITS = (1 << 64) - 1


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 (seed 42) of the UTF-8 shingles of a text: A-Z lowered, words split at ASCII white space."""
    if text is None:
        return []
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:])]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, text_key, fp): the 64-bit SimHash of every row, as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = []
            for value in batch.column(2):
                hashes = shingle_hashes(value.as_py(), width)
                ones = np.zeros(64, np.int64)
                for at in range(0, len(hashes), HASHES_AT_ONCE):
                    part = np.array(hashes[at:at + HASHES_AT_ONCE], dtype=">u8")
                    ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
                prints.append(int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64())],
                                             names=["doc_id", "text_key", "fp"])
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def block_keys(fp: Column, bits: int) -> Column:
    """The pigeonhole keys of a fingerprint: each pair of its `bits + 2` blocks, with the pair's number."""
    edges = [round(64 * i / (bits + 2)) for i in range(bits + 3)]
    block = [F.shiftrightunsigned(fp, lo).bitwiseAND((1 << (hi - lo)) - 1) for lo, hi in zip(edges, edges[1:])]
    width = max(hi - lo for lo, hi in zip(edges, edges[1:]))
    keys = [F.shiftleft(F.shiftleft(F.lit(n).cast("long"), width).bitwiseOR(block[i]), width).bitwiseOR(block[j])
            for n, (i, j) in enumerate(combinations(range(bits + 2), 2))]
    return F.array(*keys)


def _close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= bits


def _links_rows(a, b, key) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, key)], names=["a", "b", "key"])


def hamming_links(prints: DataFrame, bits: int, block: int = 512, direct: int = 32) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints (`fp`) exactly as all links at `bits` differing bits do.

    The keyed fingerprints are sorted over ranges of (key, fp), so that those with one key stand together, a large key
    over several tasks. Keys with at most `direct` fingerprints are compared where they stand. Larger keys, and keys at
    the ends of ranges, are passed on and compared in blocks, one star per connected part of a block.
    """
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        first = True
        for batch in batches:
            key = np.append(key, np.asarray(batch.column(0)))
            fp = np.append(fp, np.asarray(batch.column(1)))
            if not len(key):
                continue
            # The last key may go on in the next batch, the first may have begun in another range.
            ends = np.flatnonzero(np.append(key[1:] != key[:-1], False)) + 1
            if first and len(ends):
                yield _links_rows(fp[:ends[0]], [None] * int(ends[0]), key[:ends[0]])
                key, fp, ends, first = key[ends[0]:], fp[ends[0]:], ends[1:] - ends[0], False
            if not first and len(ends):
                yield from _compared(key[:ends[-1]], fp[:ends[-1]], bits, direct)
                key, fp = key[ends[-1]:], fp[ends[-1]:]
            elif len(key) > 1 << 20:
                yield _links_rows(fp[:-1], [None] * (len(fp) - 1), key[:-1])
                key, fp, first = key[-1:], fp[-1:], True  # what follows of this key is passed on, too
        if len(key):
            yield _links_rows(fp, [None] * len(fp), key)
    keyed = prints.select(F.explode(block_keys(F.col("fp"), bits)).alias("key"), "fp")
    found = stored(keyed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp").mapInArrow(
        sweep, "a long, b long, key long"), "swept")
    rest = found.filter("b is null").select("key", F.col("a").alias("fp")).distinct()
    met = meetings(rest, "key", "fp", block=block).select("group.fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for group in batch.column(0):
                fps = np.asarray(group.values)
                label = stars(_close(fps[:, None], fps[None, :], bits))
                other = np.flatnonzero(label != np.arange(len(fps)))
                a += fps[other].tolist()
                b += fps[label[other]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return found.filter("b is not null").select("a", "b").union(met.mapInArrow(run, "a long, b long"))


def _compared(key: np.ndarray, fp: np.ndarray, bits: int, direct: int) -> Iterator[pa.RecordBatch]:
    """Links within whole keys of a sorted run; the members of keys larger than `direct` come as rows without `b`."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    large = np.repeat(sizes > direct, sizes)
    if large.any():
        yield _links_rows(fp[large], [None] * int(large.sum()), key[large])
        key, fp = key[~large], fp[~large]
    for step in range(1, direct):
        together = np.flatnonzero(key[step:] == key[:-step])
        if not len(together):
            break
        a, b = fp[together], fp[together + step]
        near = _close(a, b, bits)
        yield _links_rows(a[near], b[near], [None] * int(near.sum()))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of its group)."""
    prints = stored(fingerprints(docs, doc_id, text, width), "prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected(hamming_links(distinct, bits)).toDF("fp", "root")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _sketch(hashes: np.ndarray) -> tuple[bytes, list[int]]:
    """The 1024-bit fingerprint of a set of shingle hashes, and its section keys."""
    ones = np.zeros((LANES, 64), np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE // LANES):
        lanes = hashes[None, at:at + HASHES_AT_ONCE // LANES] * LANE_FACTORS[:, None]
        lanes ^= lanes >> np.uint64(29)
        lanes *= np.uint64(0xBF58476D1CE4E5B9)
        ones += np.unpackbits(lanes.view(np.uint8).reshape(*lanes.shape, 8), axis=-1).reshape(
            *lanes.shape, 64).sum(axis=1, dtype=np.int64)
    wide = np.packbits(ones * 2 > len(hashes), axis=1).tobytes()
    mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
    place = mixed >> np.uint64(32)
    scale = np.log2(max(len(hashes) / SECTION_SHINGLES, 1))
    keys = []
    if len(hashes) <= SHORT:
        keys = np.sort(hashes)[:len(hashes) - int(np.ceil(LEAST * len(hashes) - 1e-9)) + 1].view(np.int64).tolist()
    if len(hashes) < SECTIONED:
        return wide, keys
    for level in sorted({int(np.floor(scale)), int(np.ceil(scale))}):
        section = place & np.uint64((1 << level) - 1)
        inside = np.flatnonzero(section < SECTIONS)
        order = inside[np.argsort(section[inside], kind="stable")]
        sections, starts, counts = np.unique(section[order], return_index=True, return_counts=True)
        if not len(starts):
            continue
        words = majority_bits(hashes[order], starts)
        for number, word, count in zip(sections.tolist(), words.tolist(), counts.tolist()):
            if count >= 3 or level == 0:
                keys.append(xxhash.xxh64_intdigest(b"%d %d %d" % (level, number, word), SEED) - (1 << 63))
    return wide, keys


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """(doc_id, digest, wide, keys, size) per row; `size` counts the shingles, `digest` is the MD5 of the text, texts without words have no keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide, keys, sizes = [], [], []
            for value in batch.column(2):
                hashes = np.unique(np.array(shingle_hashes(value.as_py(), width), np.uint64))
                found = _sketch(hashes) if len(hashes) else (b"", [])
                wide.append(found[0])
                keys.append(found[1])
                sizes.append(len(hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(wide, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sizes, pa.int32())], names=["doc_id", "digest", "wide", "keys", "size"])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("digest"),
                       F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, digest binary, wide binary, keys array<long>, size int")


def _near_links(met: DataFrame, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for group in batch.column(0):
                found = group.as_py()
                ids = [x["digest"] for x in found]
                wide = np.frombuffer(b"".join(x["wide"] for x in found), np.uint64).reshape(len(found), -1)
                apart = np.zeros((len(found), len(found)), np.int32)
                for lane in wide.T:
                    apart += np.bitwise_count(lane[:, None] ^ lane[None, :])
                size = np.array([x["size"] for x in found])
                low, high = np.minimum(size[:, None], size[None, :]), np.maximum(size[:, None], size[None, :])
                label = stars((apart <= np.where(low <= SHORT, LOOSE_BITS_SHORT, most)) & (low >= LEAST * high - 1e-9))
                for i in np.flatnonzero(label != np.arange(len(found))):
                    a.append(ids[i])
                    b.append(ids[label[i]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return met.mapInArrow(run, "a binary, b binary")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, most: int = LOOSE_BITS,
                block: int = 256, similarity: float = LEAST) -> DataFrame:
    """One row per document: doc_id, digest (MD5 of its text), root (of its group), component_id (smallest doc_id of the
    group), copies (rows that carry this id and text)."""
    rows = stored(sketches(docs, doc_id, text, width), "sketches")
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("wide").alias("wide"), F.first("keys").alias("keys"),
                                        F.first("size").alias("size"))
    texts = stored(texts, "texts")
    keyed = texts.select("digest", F.explode("keys").alias("key"))
    met = meetings(keyed, "key", "digest", texts.select("digest", "wide", "size"), block).select("group")
    near = connected(_near_links(met, most)).toDF("digest", "near")
    own = docs.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("part_id"), F.col(text).alias("part"))
    company = near.select(F.col("digest").alias("part_id"), "near")
    parts = own.join(company.select("part_id"), "part_id", "left_semi").groupBy("part_id").agg(F.first("part").alias("part"))
    from vitrine.llm.paragraph_dedup import _verified  # which takes the shingles from here
    exact = _verified(meetings(company, "near", "part_id", parts, block).select("group"), similarity, width)
    roots = connected(exact).toDF("digest", "root")
    named = texts.select("digest", "first").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_text = named.join(smallest, "root").select("digest", "root", "component_id")
    return (rows.groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
            .join(of_text, "digest").select("doc_id", "digest", "root", "component_id", "copies"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every group of near copies: the one with the smallest id, all its columns as they were.

    Where several rows carry that id (repeated rows, or near copies under one id) one of them stays. A group whose ids
    are all null keeps one row, too.
    """
    found = near_copies(docs, doc_id, text).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Equal ids of different groups are different documents.
    kept = stored(found.groupBy("root", "doc_id").agg(F.min(F.struct("digest", "copies")).alias("one")).select(
        F.col("doc_id").alias("_id"), F.col("one.digest").alias("_digest"), (F.col("one.copies") > 1).alias("_repeated")), "kept")
    rows = docs.select(whole(docs), F.col(doc_id).alias("own_id"),
                       F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("own_digest"))
    same = F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_digest") == F.col("_digest"))
    once = rows.join(kept.filter("not _repeated"), same, "left_semi")
    again = rows.join(kept.filter("_repeated"), same, "left_semi").dropDuplicates(["own_id", "own_digest"])
    return once.unionByName(again).select("row.*")
