"""Keyed merges on DataFrames: upsert, insert-only, change rows, CDC columns."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def has_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def add_cdc_columns(df: DataFrame, run_time: datetime) -> DataFrame:
    """Add updated_at, _extract_ts (the run's time) and deleted_at (NULL) where missing."""
    now = F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    wanted = {"updated_at": now, "_extract_ts": now, "deleted_at": F.lit(None).cast("timestamp")}
    return df.withColumns({c: v for c, v in wanted.items() if c not in df.columns})


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The target after inserting or overwriting the batch's rows; the batch holds each key once.

    Columns missing from the batch keep their values (NULL for new rows). Rows with a NULL in the key never
    conflict: they by-pass the join, so any number of them stays spread over the tasks, and are added unless the target
    holds their values. Both sides hold a key at most once, so the join has no hot key.
    """
    columns, given = target.columns, set(batch.columns)
    if given - set(columns):
        raise ValueError(f"batch columns not in the target: {sorted(given - set(columns))}")
    types = {f.name: f.dataType.simpleString() for f in target.schema}
    batch = batch.selectExpr(*[f"cast(`{c}` as {types[c]}) as `{c}`" for c in batch.columns])
    old = target.filter(has_key(keys)).alias("old")
    new = batch.filter(has_key(keys)).withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, F.expr(" and ".join(f"old.`{k}` = new.`{k}`" for k in keys)), "full")
    merged = joined.selectExpr(*[f"if(new._new, new.`{c}`, old.`{c}`) as `{c}`" if c in given else f"old.`{c}`"
                                 for c in columns])
    keyless = new_keyless(target, batch, keys).selectExpr(*[
        f"`{c}`" if c in given else f"cast(null as {types[c]}) as `{c}`" for c in columns])
    return merged.union(target.filter(~has_key(keys))).union(keyless)


CDC_COLUMNS = ("updated_at", "_extract_ts", "deleted_at")


def new_keyless(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch rows with a NULL in the key whose values, the times of change left out, no such row of the target has."""
    values = [c for c in batch.columns if c not in CDC_COLUMNS]
    types = {f.name: f.dataType for f in target.schema}
    digest = F.xxhash64(*[x for c in values for x in (F.col(c).cast(types[c]), F.col(c).isNull())])
    loose = batch.filter(~has_key(keys)).withColumn("_values", digest)
    known = target.filter(~has_key(keys)).select(digest.alias("_values")).distinct()
    return loose.join(known, "_values", "left_anti").drop("_values")


def insert_only(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch rows whose key the target lacks; append them to the target."""
    return batch.join(target.select(*keys), keys, "left_anti")


def change_rows(target: DataFrame, batch: DataFrame, keys: list[str], table: str, run_time: datetime) -> DataFrame:
    """One change row per batch key: an insert or an update."""
    known = target.select(*keys, F.lit(True).alias("_known"))
    now = F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    extracted = F.col("_extract_ts") if "_extract_ts" in batch.columns else F.lit(None).cast("timestamp")
    source_key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    operation = F.when(F.col("_known"), "update").otherwise("insert")
    return batch.join(known, keys, "left").select(
        # Of the row's values, too: a repeated batch gives the ids it gave before, another batch of the run others.
        F.xxhash64(F.lit(table), *sorted(batch.columns), now).alias("tracking_id"),
        F.lit(table).alias("source_table"), source_key.alias("source_key"), operation.alias("operation"),
        now.alias("changed_at"), extracted.alias("extracted_at"), now.alias("loaded_at"))
