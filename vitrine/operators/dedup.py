"""Keep one row per key.

`row_number() = 1` lets Spark keep only the best row per key inside each map task (WindowGroupLimit) before the
shuffle, so a key that holds a third of all rows sends one row per task and not its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import item_hash, present


def _first(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def row_hash(df: DataFrame) -> Column:
    """A tie-break that depends on the row's values only, so recomputed tasks choose the same row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def newest_per_key(df: DataFrame, keys: list[str], tiebreak: list[Column] | None = None,
                   time: str = "scraped_at") -> DataFrame:
    """The newest row per key, rows without a time last; without a time column any one row, always the same."""
    order = [F.col(time).desc_nulls_last()] if time in df.columns else []
    return _first(df, keys, order + (tiebreak or [row_hash(df)]))


def first_per_item(df: DataFrame, arrival: list[str], all_have_id: bool = False) -> DataFrame:
    """The first row per (product_id, source) in arrival order; rows without a product id all stay, outside the
    window, so that they form no group. `df` is then read for both parts: pass a stored frame if it is costly, or
    `all_have_id` when validation has removed such rows."""
    has_id = present(F.col("product_id").cast("string"))
    key = item_hash(F.col("product_id").cast("string"), F.col("source"))
    order = [F.col(c) for c in arrival] + [row_hash(df)]
    if all_have_id:
        return _first(df, [key], order)
    return _first(df.filter(has_id), [key], order).unionByName(df.filter(~has_id))


def first_rows(df: DataFrame, groups: list[str], order: list[str], limit: int, spread: int = 64) -> DataFrame:
    """At most `limit` rows per group, in order.

    Two rounds: a row among the group's first `limit` is also among the first `limit` of its slice, so slices are
    cut first, each in a task of its own, and only the survivors (`spread * limit` per group) meet in one task.
    """
    piece = F.pmod(F.xxhash64(*order), F.lit(spread))
    ranked = [F.col(c) for c in order]
    inner = Window.partitionBy(*groups, "_slice").orderBy(*ranked)
    outer = Window.partitionBy(*groups).orderBy(*ranked)
    return (df.withColumn("_slice", piece)
            .withColumn("_rank", F.row_number().over(inner)).filter(F.col("_rank") <= limit)
            .withColumn("_rank", F.row_number().over(outer)).filter(F.col("_rank") <= limit)
            .drop("_slice", "_rank"))
