"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits, bias correction.

1. A-Z are lowered, words split at ASCII white space. Each distinct five-word shingle is hashed once; the top bits of the
   hash are its bin, the smallest rest in a bin is the bin's value. Fewer words form one shingle.
2. An empty bin takes the value of the first filled bin in an order of all bins of its own, the same for all documents.
3. The fingerprint holds the lowest `BITS` bits of each of `BINS` values, packed, as hexadecimal digits.
4. Unlike values agree in 2^-BITS of the bins by chance: likeness = (agreeing share - 2^-BITS) / (1 - 2^-BITS), at least 0.

`edited` compares every document with its edited text and with the next document in ascending order of ids. Rows are sorted
over ranges of (id, text digest), so each text travels once; a task passes on the first and the last row of its range, and
only these few meet in a second step.

Defined results: null and empty texts, and texts without words, have a fingerprint of zeros; likeness 1 between equal
fingerprints. Rows with one id follow each other by a digest of their texts, null ids come first, equal rows follow each
other in any order. Repeated rows are rows of their own. A single row is its own next. An empty table gives an empty
result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.common import SEED, text_key
from vitrine.session import stored

WIDTH, BINS, BITS = 5, 512, 4
CHANCE = 1 / (1 << BITS)
BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
#: For every bin an order of all bins.
PROBES = np.stack([np.random.default_rng((SEED, i)).permutation(BINS) for i in range(BINS)]).astype(np.int16)
FIRST_PROBES = 8
KNOWN_WORDS = 200_000
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class _Known(dict):
    """Hashes of words, remembered in a bounded table."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def word_hashes(text: str, known: dict) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a sequence of word hashes."""
    if not len(words):
        return words
    width = min(WIDTH, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mixed(total + words[k:len(words) - width + 1 + k] * FACTORS[k])
    total.sort()
    return total[np.append(True, total[1:] != total[:-1])]


def values(hashes: np.ndarray) -> np.ndarray:
    """The densified bin values of sorted distinct shingle hashes, low-order bits only."""
    if not len(hashes):
        return np.zeros(BINS, np.uint8)
    bins = (hashes >> BIN_SHIFT).astype(np.int64)
    first = np.append(True, bins[1:] != bins[:-1])
    out, filled = np.zeros(BINS, np.uint8), np.zeros(BINS, bool)
    out[bins[first]] = hashes[first] & np.uint64((1 << BITS) - 1)
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    for lo, hi in ((0, FIRST_PROBES), (0, BINS)):  # most bins find a filled one at once
        if len(empty):
            probes = PROBES[empty, lo:hi]
            found = filled[probes]
            at = found.argmax(axis=1)
            own = found[np.arange(len(empty)), at]
            out[empty[own]] = out[probes[np.arange(len(empty)), at][own]]
            empty = empty[~own]
    return out


def packed(codes: np.ndarray) -> bytes:
    bits = np.unpackbits(codes[:, None], axis=1)[:, 8 - BITS:]
    return np.packbits(bits.ravel()).tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of the shingle sets behind two arrays of low-order bits."""
    return max(0.0, (float(np.count_nonzero(a == b)) / BINS - CHANCE) / (1 - CHANCE))


def fingerprint(text: str | None, known: dict | None = None) -> np.ndarray:
    return values(shingles(word_hashes(text or "", _Known() if known is None else known)))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fingerprint) of every row; `fingerprint` is a string of hexadecimal digits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for batch in batches:
            made = [packed(fingerprint(x.as_py(), known)).hex() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())],
                                             names=["doc_id", "text_key", "fingerprint"])
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fingerprint string")


def _pair(own: str, codes: np.ndarray, other: str, other_codes: np.ndarray, known: dict) -> tuple:
    half = len(own) // 2
    text = own[:len(own) - half] + other[:half]
    edited = fingerprint(text, known)
    return (hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), packed(codes), packed(edited),
            likeness(codes, edited), likeness(codes, other_codes))


MADE = "edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text is the document's with its last half, floor(n_chars / 2) characters, replaced by as many first ones, or
    all, of the next document; the last document is followed by the first.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), text_key(text).alias("digest"),
                       F.monotonically_increasing_id().alias("at"))  # deals out the copies of one row
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([(n, t) for n, t in (("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                                            ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                                            ("edge", pa.string()), ("part", pa.int32()), ("text", pa.string()))])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, held, ids = TaskContext.get().partitionId(), _Known(), None, None
        for batch in batches:
            at, out = [], []
            for i in range(batch.num_rows):
                own = batch.column(1)[i].as_py()
                codes = fingerprint(own, known)
                if held is None:
                    out.append((len(own), None, None, None, None, None, "first", part, own))
                    at.append(i)
                else:
                    out.append((len(held[0]), *_pair(*held, own, codes, known), "", part, None))
                    at.append(i - 1)
                held = (own, codes)
            whole = pa.chunked_array([ids, batch.column(0)]).combine_chunks() if ids is not None else batch.column(0)
            shift = 0 if ids is None else 1
            ids = batch.column(0).slice(batch.num_rows - 1) if batch.num_rows else ids
            yield _rows(whole.take(pa.array([i + shift for i in at], pa.int64())), out)
        if held is not None:
            yield _rows(ids, [(len(held[0]), None, None, None, None, None, "last", part, held[0])])

    def _rows(own_ids, out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([own_ids, *(pa.array(list(c), f.type) for c, f in zip(columns, schema))],
                                          names=["doc_id", *schema.names])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for batch in batches:
            own = [(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3))]
            made = [_pair(a, fingerprint(a, known), b, fingerprint(b, known), known) for a, b in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(list(c), f.type) for c, f in zip(zip(*made) if made else [[]] * 5, list(schema)[1:6]))],
                names=["doc_id", "n_chars", *schema.names[1:6]])

    order = ("doc_id", "digest", "at")
    made = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(
        sweep, f"doc_id {kind}, n_chars long, {MADE}, edge string, part int, text string"), "swept")
    # One first and one last row per range. Their order is found from the numbers of the ranges alone.
    first, last = made.filter("edge = 'first'"), made.filter("edge = 'last'")
    follows = first.select("part", F.lead("part").over(Window.orderBy("part")).alias("follower"), F.min("part").over(Window.partitionBy()).alias("start"))
    follows = follows.select("part", F.coalesce("follower", "start").alias("follower"))
    open_rows = (last.select("doc_id", "n_chars", "text", "part").join(follows, "part")
                 .join(first.select(F.col("part").alias("follower"), F.col("text").alias("next")), "follower"))
    closed = open_rows.select("doc_id", "n_chars", "text", "next").mapInArrow(close, f"doc_id {kind}, n_chars long, {MADE}")
    out = made.filter("edge = ''").select(*closed.columns).union(closed)
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
