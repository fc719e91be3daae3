"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - score) with ordered thresholds and one score for all of them, a sum of shared
weights of hashed text features. The expected grade is the sum of the tail probabilities P(grade > k); documents are
selected where the tail probability of the best grade is at least 0.8.

Grades of the test labels: 0 poor, 1 good but toxic, 2 good. The model is fitted on at most `per_grade` labelled
documents of each grade, in hash order, weighted back to the grades' true shares; features of these are computed by
Spark, and only their hashed counts reach the driver. All documents are scored.

Features of a whole text: lower-case word cores and their beginnings (compounds and inflections), trailing and leading marks, letter shapes, and a few shares (repeated
words, words with marks) in steps of a tenth; counts enter as 1 + log, scaled to unit length.

Defined results: null and wordless texts have no features and a score of 0, they are not accepted; rows with null ids
are scored, only not used for fitting; labels with null grades are left out, of repeated labels the lowest grade counts.
Without labels every document has tail probability 0.5 and none is accepted. Other columns pass through `select`. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vitrine.llm.common import whole

BUCKETS = 1 << 18
GRADES = 3
KNOWN_WORDS = 100_000
SPLIT = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.S)


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """2 for good, 1 for good but toxic, 0 for poor."""
    return F.when(F.col(quality) == 0, 0).when(F.col(toxic) == 1, 1).when(F.col(quality) == 1, 2)


def _bucket(feature: str) -> int:
    return crc32(feature.encode()) % BUCKETS


class Features:
    """Hashed features of texts; what words hash to is remembered in a bounded table."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        if (found := self.known.get(word)) is None:
            before, core, after = ("", word, "") if word.isalnum() else SPLIT.match(word).groups()
            shape = 1 if len(core) > 1 and core.isupper() else 2 if core[:1].isupper() else 3 if core.isdigit() else 4
            low = core.lower().encode("utf-8", "surrogatepass")
            found = (crc32(low) % BUCKETS, crc32(low[:4], 5) % BUCKETS, crc32(low[:5], 6) % BUCKETS, shape)
            if before:
                found += (crc32(before[:8].encode("utf-8", "surrogatepass"), 7) % BUCKETS,)
            if after:
                found += (crc32(after[:8].encode("utf-8", "surrogatepass"), 8) % BUCKETS,)
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def of_text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted feature numbers and their values."""
        words = (text or "").split()
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        times = Counter(words)
        known, of_word = self.known.get, self.of_word
        of_words = [known(w) or of_word(w) for w in times]
        numbers = np.fromiter(chain.from_iterable(of_words), np.int64)
        repeats = np.repeat(np.fromiter(times.values(), np.float64), [len(f) for f in of_words])
        marked = sum(not w[-1].isalnum() for w in words) / len(words)
        repeated = 1 - len(times) / len(words)
        shares = [_bucket(f"marked {int(10 * marked)}"), _bucket(f"repeated {int(10 * repeated)}"),
                  _bucket(f"length {int(math.log2(len(words)))}")]
        found, at = np.unique(numbers, return_inverse=True)
        values = 1 + np.log(np.bincount(at, repeats))
        found, values = np.append(found, shares).astype(np.int32), np.append(values, [8.0] * 3)
        return found, (values / np.linalg.norm(values)).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, numbers: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[numbers] @ values) if len(numbers) else 0.0

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(scores)[:, None], -60, 60)))


def fit_model(row: np.ndarray, number: np.ndarray, value: np.ndarray, grades: np.ndarray, share: np.ndarray,
              steps: int = 300, rate: float = 1.0, ridge: float = 1e-6, least_rows: int = 10) -> Model:
    """Maximum likelihood by Adam over all given rows; `share` weighs the grades. Features of fewer than `least_rows`
    rows keep weight 0: they could only tell the rows of the sample apart."""
    n = len(grades)
    often = np.bincount(number, minlength=BUCKETS)[number] >= min(least_rows, n / 20)
    row, number, value = row[often], number[often], value[often]
    weight = share[grades] * n / share[grades].sum()
    weights, cuts = np.zeros(BUCKETS), np.array([-2.0, math.log(1.0)])  # first threshold, log of the step to the second
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, cuts)]
    for step in range(1, steps + 1):
        score = np.bincount(row, value * weights[number], n)
        edges = np.array([cuts[0], cuts[0] + math.exp(cuts[1])])
        below = 1 / (1 + np.exp(np.clip(score[:, None] - np.concatenate(([-np.inf], edges, [np.inf]))[None, :], -60, 60)))
        below[:, 0], below[:, -1] = 0, 1
        low, high = below[np.arange(n), grades], below[np.arange(n), grades + 1]
        push = weight * (1 - high - low)  # slope of -log likelihood by the score
        chance = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high) / chance, low * (1 - low) / chance
        by_edge = [(weight * (np.where(grades == k + 1, down, 0) - np.where(grades == k, up, 0))).sum() / n for k in range(2)]
        slopes = (np.bincount(number, value * push[row], BUCKETS) / n + ridge * weights,
                  np.array([by_edge[0] + by_edge[1], by_edge[1] * math.exp(cuts[1])]))
        for p, slope, (first, second) in zip((weights, cuts), slopes, moments):
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            p -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return Model(weights.astype(np.float32), np.array([cuts[0], cuts[0] + math.exp(cuts[1])]))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", per_grade: int = 2000) -> tuple[DataFrame, np.ndarray]:
    """(grade, text) of at most `per_grade` labelled documents of each grade, and how many ids have each grade. A document
    counts once per id and text, however often its row is repeated; of many texts under one id, hash order decides."""
    graded = labels.select(F.col(doc_id).alias("label_id"), "grade").dropna().groupBy("label_id").agg(F.min("grade").alias("grade"))
    share = np.zeros(GRADES)
    for r in graded.groupBy("grade").count().collect():
        share[int(r["grade"])] = r["count"]
    parts = [graded.filter(F.col("grade") == g).orderBy(F.xxhash64("label_id"), "label_id").limit(per_grade) for g in range(GRADES)]
    picked = F.broadcast(parts[0].unionByName(parts[1]).unionByName(parts[2]))  # at most GRADES * per_grade ids
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(picked, F.col("id") == F.col("label_id"))
    once = rows.withColumn("digest", F.md5("text")).groupBy("id", "digest").agg(F.first("grade").alias("grade"), F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("grade").orderBy(F.xxhash64("id", "digest"), "id", "digest"))
    return once.withColumn("place", place).filter(F.col("place") <= per_grade).select(F.col("grade").cast("int").alias("grade"), "text"), share


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", per_grade: int = 2000) -> Model:
    """Fit on at most `per_grade` labelled documents of each grade; `labels` has the document id and `grade`."""
    rows, share = sample(docs, labels, doc_id, text, per_grade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of_text(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))],
                names=["grade", "numbers", "values"])
    found = rows.mapInArrow(
        run, "grade int, numbers array<int>, values array<float>").toArrow()
    if not found.num_rows:
        return Model(np.zeros(BUCKETS, np.float32), np.array([-1.0, 0.0]))
    lists = found.column("numbers").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    grades = np.asarray(found.column("grade"))
    counted = np.bincount(grades, minlength=GRADES)
    return fit_model(np.repeat(np.arange(len(grades)), sizes), np.asarray(lists.flatten()),
                     np.asarray(found.column("values").combine_chunks().flatten()), grades, share / np.maximum(counted, 1))


def rate(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """`row` (all columns of a document), `expected_grade`, `tail_probability` (of the best grade) and `accepted`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one megabyte, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, own = Features(), shared.value
        for batch in batches:
            at = batch.schema.get_field_index("row")
            texts = batch.column(at).field(text)
            found = [features.of_text(t.as_py()) for t in texts]
            tails = own.tails([own.score(*f) for f in found])
            words = np.array([len(f[0]) > 0 for f in found], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(at), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array((tails[:, -1] >= least) & words)],
                names=["row", "expected_grade", "tail_probability", "accepted"])
    rows = docs.select(whole(docs))
    schema = T.StructType([rows.schema["row"], T.StructField("expected_grade", T.DoubleType()),
                           T.StructField("tail_probability", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def select(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """The accepted documents, columns as they were."""
    return rate(docs, train(docs, labels, doc_id, text), doc_id, text, least).filter("accepted").select("row.*")
