"""Drop files as streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import item_hash
from ..plans.raw_load import file_results, load_rows, record_files
from ..schemas import drop_schema
from ..session import stored
from ..sources.catalog import Warehouse
from ..sources.files import inspect_files, read_inspected


def new_files(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """The paths of new drop files below a folder (`*.json`, `*.jsonl`, `*.parquet`); at most `max_files` per micro-batch.
    Contents are not read."""
    return (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,jsonl,parquet}")
            .option("maxFilesPerTrigger", max_files).load(folder).select(F.col("path").alias("_file")))


def load_new_files(house: Warehouse, shop: str, folder: str, checkpoint: str, run_time: datetime,
                   max_files: int = 1000) -> StreamingQuery:
    """Merge the files that are new since the last call into the shop's raw table, then stop.

    Files may be of any form that `read_shop_drops` takes; each gives its lineage row, refused ones with the error. A
    micro-batch that is repeated after a failure merges the same rows again and adds no change or lineage row.
    """
    house.create_all()

    def merge(batch: DataFrame, _: int) -> None:
        inspected = stored(inspect_files(batch), "stream-files")
        if inspected.isEmpty():
            return
        rows = stored(read_inspected(house.spark, drop_schema(shop), inspected), "stream-drops")
        load_rows(house, shop, rows, run_time)
        record_files(house, shop, stored(file_results(inspected, shop, rows, house.key(f"raw.{shop}")), "stream-results"), run_time)

    return (new_files(house.spark, folder, max_files).writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _timed(items: DataFrame) -> DataFrame:
    """Watermarks need a time with zone."""
    return items.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))


def first_seen(items: DataFrame, delay: str) -> DataFrame:
    """The first item per (product_id, source) in a stream; keys older than the watermark are forgotten."""
    keyed = _timed(items).withColumn("item_hash", item_hash(F.col("product_id"), F.col("source")))
    return keyed.withWatermark("scraped_at", delay).dropDuplicatesWithinWatermark(["item_hash"])


def daily_volume(items: DataFrame, delay: str) -> DataFrame:
    """Items per day and source of a stream. The watermark bounds the state: items later than `delay` are not counted.
    Days it has not closed yet come out in update mode (`run_updates`) only."""
    return (_timed(items).withWatermark("scraped_at", delay)
            .groupBy(F.window("scraped_at", "1 day").alias("day"), "source").agg(F.count("*").alias("count"))
            .select(F.col("day.start").alias("scraped_date"), "source", "count"))


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is available in update mode; each micro-batch's changed rows go to a folder of their own, which a
    repeated batch overwrites."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
     .trigger(availableNow=True).start().awaitTermination())


def latest_updates(spark: SparkSession, path: str, keys: list[str], schema: str) -> DataFrame:
    """The newest row per key of what `run_updates` wrote."""
    rows = spark.read.schema(f"{schema}, batch bigint").option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(*(F.max_by(c, "batch").alias(c) for c in values))


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is available and append the results as Parquet files."""
    (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
