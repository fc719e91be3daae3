"""Spelling variants: words one edit apart, found by a bit-sliced position index, and grouped under their commonest form.

1. Words and their counts are native aggregates over whole texts.
2. Two words of which one has c letters and the other c or c + 1 and that are one edit apart share their first c // 2 letters
   or their last c // 2. Words meet in classes (c, side, part of a hash of that half), so that a class holds all words with
   its halves; classes above `BLOCK` words meet in blocks, every two blocks once (`common.meetings`).
3. Inside a meeting, a bitset per (position, letter) tells which words have that letter there. For all words of c letters at
   once the letters are read from left to right, with three bitsets of words a reader: no error so far; one letter replaced;
   one letter inserted, which reads the positions shifted by one. At the end of the word the last two hold its near words.
   Only three positions of the index exist at a time, so that long words need no more memory than their letters.
4. A pair is reported by its first class only: by the last halves where the first halves differ. Each meeting reports one row
   per word: how many near words, and the commonest.
5. A word's form is its commonest near word if that is at least `ratio` times as common; roots follow forms by pointer
   doubling, a few rounds, as counts grow by `ratio` each step.

Defined results: null texts have no words, a null id counts as `null` in the hash of step 1. Repeated rows count again. No
two rows of the result have one word. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import lower_ascii, meetings
from vitrine.session import measured, stored

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: Words of a class on average, and in a block of a class; longer words meet in smaller blocks.
CLASS, BLOCK = 1024, 2048
LONG, LONG_BLOCK = 64, 32
READERS = 256


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", drop_one_in: int = 199, least_length: int = 6,
          least_count: int = 5) -> DataFrame:
    """(word, n): runs of letters, A-Z lowered. Where `drop_one_in` divides the CRC-32 of `<id>:<run>`, that number modulo
    the length names a letter that the run loses."""
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select(lower_ascii(F.col("run")).alias("run"), "id").withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % drop_one_in == 0, shorter).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count))


def _letters(own: list[str]) -> np.ndarray:
    """Letters of words as a matrix of code points, 0 beyond a word's end."""
    width = max(map(len, own))
    return np.array([w.ljust(width, "\0") for w in own], f"<U{width}").view(np.uint32).reshape(len(own), width)


def _slice(column: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """One position of the index: for each letter of `letters` the bitset of words that have it there."""
    bits = np.zeros((len(letters), -(-len(column) // 64) * 64), bool)
    bits[:, :len(column)] = letters[:, None] == column[None, :]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def near_words(readers: list[str], vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Positions (reader, word) of all pairs where a reader becomes the word by one letter replaced or inserted. All readers
    have one length, the words that or one more; longer and shorter ones are never near."""
    size = len(readers[0])
    table = np.zeros((len(vocabulary), size + 1), np.uint32)
    seen = _letters([w[:size + 1] for w in vocabulary])
    table[:, :seen.shape[1]] = seen
    lengths = np.array([len(w) for w in vocabulary])
    ends = _slice(lengths, np.array([size, size + 1]))
    read = _letters(readers)
    a_all, b_all = [], []
    for start in range(0, len(readers), READERS):
        part = read[start:start + READERS]
        exact = np.repeat((ends[0] | ends[1])[None], len(part), axis=0)
        replaced, here = np.zeros_like(exact), None
        # A letter may be inserted before the first one: then position 1 is read against letter 0.
        inserted = exact & ends[1]
        for k in range(size):
            letters, at = np.unique(part[:, k], return_inverse=True)
            here, ahead = _slice(table[:, k], letters)[at], _slice(table[:, k + 1], letters)[at]
            inserted &= ahead
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            inserted |= exact & ends[1]
            replaced &= ends[0]
        found = np.unpackbits((replaced | inserted).view(np.uint8), axis=1, bitorder="little")[:, :len(vocabulary)]
        a, b = np.nonzero(found)
        a_all.append(a + start)
        b_all.append(b)
    return np.concatenate(a_all), np.concatenate(b_all)


def _met(c: int, side: int, across: bool, group: list[dict]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, count of the commonest, the commonest) of the words of one meeting."""
    own = [m["word"] for m in group]
    readers = [i for i, w in enumerate(own) if len(w) == c]
    if not readers:
        return
    a, b = near_words([own[i] for i in readers], own)
    a = np.array(readers, np.int64)[a]
    once = (np.array([len(w) for w in own])[b] > c) | (a < b)  # of two words of one length each reads the other
    if across:
        part = np.array([m["of_part"] for m in group])
        once &= part[a] != part[b]
    a, b = a[once], b[once]
    # Words of other halves stand in the class, too: equal first halves count here, unequal ones where last halves meet.
    half = np.unique([w[:c // 2] for w in own], return_inverse=True)[1]
    mine = (half[a] == half[b]) == (side == 0)
    a, b = a[mine], b[mine]
    if not len(a):
        return
    n = np.array([m["n"] for m in group], np.int64)
    rank = sorted(range(len(own)), key=lambda i: (-n[i], own[i]))
    place = np.empty(len(own), np.int64)
    place[rank] = np.arange(len(own))
    best, near = np.full(len(own), len(own), np.int64), np.bincount(np.concatenate([a, b]), minlength=len(own))
    np.minimum.at(best, np.concatenate([a, b]), place[np.concatenate([b, a])])
    for i in np.flatnonzero(near).tolist():
        top = rank[best[i]]
        yield own[i], int(near[i]), int(n[top]), own[top]


def neighbours(vocabulary: DataFrame, count: int, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best) of the words of `vocabulary` (word, n; `count` rows) that have a near word."""
    half = lambda side: F.substring("word", F.lit(1), F.floor(F.col("c") / 2).cast("int")) if side == 0 else F.expr("right(word, c div 2)")
    # Classes of words of c letters and of c + 1; the shares of a class follow the size of the vocabulary.
    classed = vocabulary.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("c"))
    parts = max(count // CLASS, 1)
    sided = [classed.select("c", F.lit(side).alias("side"), F.pmod(F.xxhash64(half(side)), F.lit(parts)).alias("p"), "word", "n") for side in (0, 1)]
    members = sided[0].union(sided[1]).select(F.struct("c", "side", "p").alias("key"), F.struct("word", "n").alias("member"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, across, group in zip(*(batch.column(i) for i in range(3))):
                key = key.as_py()
                group = [{**m["member"], "of_part": m["of_part"]} for m in group.as_py()]
                out = list(zip(*_met(key["c"], key["side"], across.as_py(), group))) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                                 names=["word", "near", "best_n", "best"])
    short = F.col("key.c") <= LONG
    met = meetings(members.filter(short), "key", "member", block=block).union(meetings(members.filter(~short), "key", "member", block=min(block, LONG_BLOCK)))
    found = met.select("key", "across", "group").mapInArrow(run, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("top")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all rows of `forms` (word, form): where following the forms ends."""
    live, seen = measured(forms.select("word", F.col("form").alias("root")), "forms", F.count("root").alias("open"))
    while seen["open"]:
        # A root that has a form itself is replaced by the root found for it so far.
        ahead = live.filter("root is not null").toDF("root", "further")
        moved = live.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        live, seen = measured(moved, "roots", F.count_if("moved").alias("open"))
        live = live.drop("moved")
    return live.select("word", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = 5, drop_one_in: int = 199,
             least_length: int = 6, least_count: int = 5, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word with enough letters and occurrences."""
    vocabulary, seen = measured(words(docs, doc_id, text, drop_one_in, least_length, least_count), "words", F.count("*").alias("n"))
    near = neighbours(vocabulary, seen["n"], block)
    better = F.col("best_n") >= ratio * F.col("n")
    forms = stored(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("best")).alias("form"),
        F.when(better, F.col("best_n")).alias("form_n")), "forms")
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
