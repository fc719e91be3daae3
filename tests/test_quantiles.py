"""Exact quantiles: rounds of narrowing cells against numpy, ties, signs, extreme scales, and no large cell in one task."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import quantiles as q

PROBS = (0.0, 0.25, 0.5, 0.9, 1.0)


def expected(values):
    return [float(x) for x in np.quantile(np.array(values), PROBS)]


def found(spark, groups, small):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("empty", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    return {r.g: (r.n, [r[f"q{i}"] for i in range(len(PROBS))]) for r in q.quantiles(df, "g", "v", PROBS, small).collect()}


@pytest.mark.parametrize("small", [1, 50, q.SMALL])
def test_quantiles_agree_with_numpy(spark, small):
    rng = random.Random(small)
    groups = {
        "close": [100 + rng.random() * 1e-9 for _ in range(3000)],
        "wide": [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(1500)],
        "ties": [rng.choice((-2.5, 0.0, -0.0, 7.0)) for _ in range(2000)],
        "tiny": [rng.randrange(1, 4000) * 5e-324 for _ in range(1500)],
        "one": [3.25], "two": [1.0, 2.0], None: [rng.gauss(0, 1) for _ in range(1000)],
    }
    got = found(spark, groups, small)
    assert set(got) == set(groups)
    for name, values in groups.items():
        assert got[name][0] == len(values)
        assert got[name][1] == pytest.approx(expected(values), rel=1e-12, abs=5e-324), name


def test_many_distinct_values_in_one_first_cell(spark, monkeypatch):
    """Two million different values within 0.1 %: no more than `small` rows of them are ranked in one window."""
    ranked_cells = []
    keep = q.measured

    def spy(df, label, *metrics):
        out = keep(df, label, *metrics)
        if label == "cells":
            ranked_cells.append([(r._c, r._lo < r._hi) for r in out[0].collect()])
        return out
    monkeypatch.setattr(q, "measured", spy)
    df = spark.range(2_000_000).select(F.lit("hot").alias("g"), (1000 + F.col("id") / 2_000_000).alias("v"))
    (row,) = q.quantiles(df, "g", "v", (0.25, 0.5, 0.75), 10_000).collect()
    assert row.n == 2_000_000 and [row.q0, row.q1, row.q2] == pytest.approx(list((1000.25 - 0.125e-6, 1000.5 - 0.25e-6, 1000.75 - 0.375e-6)), rel=1e-12)
    assert len(ranked_cells) == 2 and all(n <= 10_000 or not spread for n, spread in ranked_cells[-1])
    assert max(n for n, _ in ranked_cells[0]) > 400_000


def test_a_round_scans_once_for_all_probabilities(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    cells = df.select(F.col("g").alias("_g"), F.col("v").alias("_v")).groupBy("_g", q._cell(F.col("_v")).alias("_cell")).agg(F.count("*"))
    assert cells._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert q.quantiles(df.limit(0), "g", "v", PROBS).count() == 0
