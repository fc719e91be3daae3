"""Drop files to raw tables, with change rows and lineage."""

from __future__ import annotations

import time
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.dedup import newest_per_key
from ..operators.lineage import lineage_row, with_lineage_id
from ..operators.upsert import add_cdc_columns, change_rows
from ..schemas import SHOPS
from ..session import in_parallel, measured, stored
from ..sources.catalog import Warehouse
from ..sources.files import (CORRUPT, coerce_to_raw, drop_schema, list_files, read_json_drops, read_parquet_drops,
                             read_shop_drops)


class EmptyBatch(ValueError):
    """A batch without rows."""


def measured_batch(batch: DataFrame, table: str, required: tuple[str, ...] = (), min_rows: int = 0
                   ) -> tuple[DataFrame, int, list[str]]:
    """The batch written once, its row count, and warnings (too few rows, NULLs in required columns)."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in required if c in batch.columns]
    batch, facts = measured(batch, table, F.count(F.lit(1)).alias("_n"), *nulls)
    count = facts.pop("_n")
    few = [f"{table}: {count} rows, at least {min_rows} are needed"] if count < min_rows else []
    return batch, count, few + [f"{table}: {n} NULL in {c}" for c, n in facts.items() if n]


def upsert_table(house: Warehouse, table: str, batch: DataFrame, run_time: datetime,
                 keys: tuple[str, ...] | None = None, ignore_conflicts: bool = False, track_changes: bool = True,
                 required: tuple[str, ...] = (), warnings: list[str] | None = None) -> int:
    """Merge a batch (each key once) into a table, adding CDC columns; returns the batch's row count.

    An empty batch changes nothing. `ignore_conflicts` inserts new keys only. The batch is written once: facts,
    merge and change rows read it from there.
    """
    keys = list(keys or house.key(table) or ("product_id",))
    batch, count, found = measured_batch(add_cdc_columns(batch, run_time), table, required)
    if warnings is not None:
        warnings.extend(found)
    if count == 0:
        return 0
    if house.exists(table):
        touched = house.touched(table, batch, keys)
        known = touched[0].drop("_cell")
    else:
        touched, known = None, batch.limit(0)
    if track_changes:
        changes = stored(change_rows(known, batch, keys, table, run_time), "changes")
    if touched is None:
        house.replace(table, batch, keys)
    else:
        house.merge(table, batch, keys, ignore_conflicts, touched)
    if track_changes:  # after the switch, and once: the same batch of the same run again adds nothing
        house.append_once("lineage.change_tracking", changes, "tracking_id", str(run_time), table)
    return count


def load_rows(house: Warehouse, shop: str, drops: DataFrame, run_time: datetime) -> int:
    """Text rows of a shop's drop files into its raw table: typed, the newest per key, merged."""
    table = f"raw.{shop}"
    sound = drops.filter(F.col(CORRUPT).isNull()) if CORRUPT in drops.columns else drops
    now = F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    typed = coerce_to_raw(sound, shop).withColumns({c: F.coalesce(c, now) for c in ("updated_at", "_extract_ts")})
    return upsert_table(house, table, newest_per_key(typed, list(house.key(table))), run_time)


def load_files(house: Warehouse, shop: str, paths: list[str], run_time: datetime, kind: str = "json",
               min_rows: int = 0) -> int:
    """Load given JSON or Parquet files of a shop; no records in JSON load nothing, in Parquet are an error."""
    started = time.monotonic()
    schema = drop_schema(shop)
    reader = read_json_drops if kind == "json" else read_parquet_drops
    drops = stored(reader(house.spark, schema, *paths), "drops")
    facts = drops.agg(F.count("*").alias("n"), F.count(CORRUPT).alias("bad")).first()
    if facts.bad:
        raise ValueError(f"{facts.bad} of the files {paths} are not readable")
    if facts.n == 0:
        if kind == "parquet":
            raise EmptyBatch(f"no rows for raw.{shop}")
        return 0
    if facts.n < min_rows:
        raise ValueError(f"raw.{shop} got {facts.n} rows, at least {min_rows} are needed")
    count = load_rows(house, shop, drops, run_time)
    house.append("lineage.data_lineage", lineage_row(
        house.spark, ", ".join(paths), "file", f"raw.{shop}", "load", count, run_time,
        time.monotonic() - started))
    return count


def file_results(files: DataFrame, shop: str, drops: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per drop file: status, records after removing repeats within the file, and the error."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    found = files.select(plain("_file").alias("file"), F.col("_file").endswith(".parquet").alias("columnar"))
    # Texts are compared of refused rows only: the distinct keys of all others are counted without a sort. The path is made
    # plain once per file, not per row.
    sound = (drops.filter(F.col(CORRUPT).isNull()).select("_file", *keys).distinct()
             .groupBy("_file").agg(F.count("*").alias("records")))
    refused = drops.filter(F.col(CORRUPT).isNotNull()).groupBy("_file").agg(F.count("*").alias("bad"), F.min(CORRUPT).alias("text"))
    read = sound.join(refused, "_file", "full").withColumn("file", plain("_file")).drop("_file")
    joined = found.join(read, "file", "left")
    records = F.coalesce("records", F.lit(0))
    error = (F.when(F.col("columnar") & (F.col("bad") > 0), F.col("text"))
             .when(F.col("bad") > 0, F.concat(F.col("bad"), F.lit(" records not readable as JSON")))
             .when(F.col("records").isNull() & F.col("columnar"), "no rows"))
    # A file with some sound records is loaded; its result names how many were refused.
    return joined.select(
        F.lit(shop).alias("shop"), "file",
        F.when(error.isNull(), "success").when(records > 0, "partial").otherwise("error").alias("status"),
        records.alias("count"), error.alias("error"))


def record_files(house: Warehouse, shop: str, per_file: DataFrame, run_time: datetime) -> None:
    """A lineage row for every file that gave rows or was refused in whole or in part, once per run."""
    now = F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    runs = per_file.filter((F.col("count") > 0) | (F.col("status") != "success")).select(
        F.col("file").alias("source_name"), F.lit("file").alias("source_type"), F.lit("raw").alias("target_schema"),
        F.lit(shop).alias("target_table"), F.lit("load").alias("operation"), F.col("count").alias("record_count"),
        now.alias("execution_time"), "status", F.col("error").alias("error_message"))
    house.append_once("lineage.data_lineage", with_lineage_id(runs), "lineage_id", str(run_time), f"load {shop}")


def load_directory(house: Warehouse, data_dir: str, run_time: datetime) -> DataFrame:
    """Load the drop files of all shops; returns a result row per file. A bad file does not stop the others.

    All files of a shop go into one batch, so the newest row wins whatever file it is in, and the table is
    rewritten once.
    """
    house.create_all()

    def load(shop: str) -> DataFrame | None:
        drops = read_shop_drops(house.spark, data_dir, shop)
        if drops is None:
            return None
        drops = stored(drops, f"drops-{shop}")
        load_rows(house, shop, drops, run_time)
        files = list_files(house.spark, f"{data_dir}/{shop}", "*.{json,jsonl,parquet}")
        per_file = stored(file_results(files, shop, drops, house.key(f"raw.{shop}")), f"files-{shop}")
        record_files(house, shop, per_file, run_time)
        return per_file

    results = [r for r in in_parallel(house.spark, load, SHOPS) if r is not None]
    if not results:
        return house.spark.createDataFrame([], "shop string, file string, status string, count bigint, error string")
    return reduce(DataFrame.unionByName, results)
