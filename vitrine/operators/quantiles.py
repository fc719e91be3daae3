"""Exact quantiles per group without gathering a group in one task.

`percentile` keeps every distinct value of a group in one aggregation buffer, which a source with a third of all
rows would overflow. Here values are dealt to cells in their order, by a partial aggregation that keeps a count and
the smallest and largest value of each cell. Cells that hold a wanted rank and more than `SMALL` rows are dealt anew,
between their own smallest and largest value, until they are small or hold one value only. A round is one scan for
all groups and ranks; a cell is narrowed to 1/4096 of its width or less each time, so that doubles need five rounds at
most and usual data one. Only rows of small cells are ranked, one cell in a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import measured, stored

# First cells per power of two: neighbours differ by 0.27 % of the value. All doubles span about a million.
CELLS_PER_POWER = 256
CELLS = 4096
SMALL = 100_000


def _cell(value: Column) -> Column:
    """Order-preserving cell number of a double (each step is monotone, so equal order is kept exactly)."""
    power = F.floor((F.log2(F.abs(value)) + 1100) * CELLS_PER_POWER).cast("bigint")
    return F.when(value == 0, F.lit(0).cast("bigint")).otherwise(F.signum(value).cast("bigint") * power)


def _subcell(value: Column) -> Column:
    """Number of a value among equal parts of its cell; the smallest and the largest value are in different ones."""
    return F.least(F.floor((value - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * CELLS), F.lit(CELLS - 1)).cast("bigint")


def _holding(cells: DataFrame, *of: str) -> DataFrame:
    """The cells in which wanted ranks (`_ranks`, counted after `_before` rows) fall, with these ranks."""
    upto = Window.partitionBy(*of).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = cells.withColumn("_before", F.col("_before") + F.sum("_c").over(upto) - F.col("_c"))
    inside = F.filter("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")))
    return (counted.withColumn("_ranks", inside).filter(F.size("_ranks") > 0)
            .select("_g", "_n", "_lo", "_hi", "_c", "_before", "_ranks"))


def _within(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows in the cells. Cells of a group do not overlap; a few rows per group, broadcast where Spark finds them small."""
    same = F.col("_g").eqNullSafe(F.col("_wg")) & F.col("_v").between(F.col("_lo"), F.col("_hi"))
    return rows.join(cells.withColumnRenamed("_g", "_wg"), same).drop("_wg")


def ranked(rows: DataFrame, ranks: Column, small: int = SMALL) -> DataFrame:
    """(_g, _n, _rank, _v): the value at each wanted zero-based rank of each group of `rows` (_g, _v). `ranks` may use `_n`."""
    measures = (F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    cells = (rows.groupBy("_g", _cell(F.col("_v")).alias("_cell")).agg(*measures)
             .withColumn("_n", F.sum("_c").over(Window.partitionBy("_g")))
             .withColumn("_ranks", ranks).withColumn("_before", F.lit(0).cast("bigint")))
    large = (F.col("_c") > small) & (F.col("_lo") < F.col("_hi"))
    settled, found = [], _holding(cells, "_g")
    while True:
        found, seen = measured(found, "cells", F.count_if(large).alias("open"))
        settled.append(found.filter(~large))
        if not seen["open"]:
            break
        wide = found.filter(large)
        inner = (_within(rows, wide.select("_g", "_lo", "_hi")).groupBy("_g", F.col("_lo").alias("_of"), _subcell(F.col("_v")).alias("_cell"))
                 .agg(*measures))
        asked = wide.select(F.col("_g").alias("_wg"), F.col("_lo").alias("_wlo"), "_n", "_ranks", "_before")
        found = _holding(inner.join(asked, F.col("_g").eqNullSafe(F.col("_wg")) & (F.col("_of") == F.col("_wlo"))), "_g", "_of")
    cells = reduce(DataFrame.union, settled)
    one = F.col("_lo") == F.col("_hi")
    single = cells.filter(one).select("_g", "_n", F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_v"))
    several = cells.filter(~one)
    inside = Window.partitionBy("_g", "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = (_within(rows, several.select("_g", "_lo", "_hi")).groupBy("_g", "_lo", "_v").agg(F.count("*").alias("_c"))
              .withColumn("_upto", F.sum("_c").over(inside)))
    asked = several.select(F.col("_g").alias("_wg"), F.col("_lo").alias("_wlo"), "_n", "_before", F.explode("_ranks").alias("_rank"))
    place = F.col("_rank") - F.col("_before")
    picked = (values.join(asked, F.col("_g").eqNullSafe(F.col("_wg")) & (F.col("_lo") == F.col("_wlo")))
              .filter((place >= F.col("_upto") - F.col("_c")) & (place < F.col("_upto"))))
    return single.union(picked.select("_g", "_n", "_rank", "_v"))


def quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], small: int = SMALL) -> DataFrame:
    """One row per group: the group, `n` (values that are numbers) and `q0`, `q1`, ... for `probs`, with linear
    interpolation between ranks."""
    rows = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    # Zero-based ranks wanted: the two neighbours of each quantile's position.
    places = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in places])))
    picked = ranked(rows, ranks, small)

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col("_v")))

    sides = [x for i, p in enumerate(places)
             for x in (at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}"))]
    out = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (p - F.floor(p))).alias(f"q{i}")
           for i, p in enumerate(places)]
    return (picked.groupBy("_g", "_n").agg(*sides)
            .select(F.col("_g").alias(group), F.col("_n").alias("n"), *out))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles and whiskers (the outermost values within 1.5 interquartile ranges) per group."""
    box = stored(quantiles(df, group, value, (0.25, 0.5, 0.75))
                 .select(F.col(group).alias("_bg"), "n", F.col("q0").alias("q1"), F.col("q1").alias("median"),
                         F.col("q2").alias("q3")), "box")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    near = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return (df.select(group, value).filter(F.col(value).isNotNull())
            .join(box, F.col(group).eqNullSafe(F.col("_bg")))
            .groupBy(group, "n", "q1", "median", "q3")
            .agg(F.min(F.when(near, F.col(value))).alias("lower_whisker"),
                 F.max(F.when(near, F.col(value))).alias("upper_whisker")))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed; empty bins are left out."""
    rows = df.select(F.col(value).cast("double").alias("_v")).filter("_v is not null")
    limits = stored(rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")), "limits")
    low, high = limits.select("lo").scalar(), limits.select("hi").scalar()
    width = (high - low) / bins
    place = F.floor((F.col("_v") - low) / F.nullif(width, F.lit(0.0)))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (rows.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))
            .select("bin", (low + width * F.col("bin")).alias("bin_start"),
                    (low + width * (F.col("bin") + 1)).alias("bin_end"), "n"))
