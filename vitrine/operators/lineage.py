"""Lineage rows and their reports."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import DATA_LINEAGE


def lineage_row(spark: SparkSession, source_name: str, source_type: str, target: str, operation: str,
                record_count: int, execution_time: datetime, duration_seconds: float = 0.0,
                status: str = "success", error_message: str | None = None, checksum: str | None = None,
                parent_lineage_id: int | None = None) -> DataFrame:
    """One lineage row; `target` is `schema.table`."""
    schema, _, table = target.rpartition(".")
    row = spark.range(1).select(
        F.lit(source_name).alias("source_name"), F.lit(source_type).alias("source_type"),
        F.lit(schema or "raw").alias("target_schema"), F.lit(table).alias("target_table"),
        F.lit(operation).alias("operation"), F.lit(int(record_count)).alias("record_count"),
        F.lit(execution_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp").alias("execution_time"),
        F.lit(duration_seconds).alias("duration_seconds"), F.lit(status).alias("status"),
        F.lit(error_message).alias("error_message"), F.lit(checksum).alias("checksum"),
        F.lit(parent_lineage_id).alias("parent_lineage_id"))
    return with_lineage_id(row)


def with_lineage_id(rows: DataFrame) -> DataFrame:
    """Give lineage rows an id that depends on their values, in the table's column order and types."""
    identity = F.xxhash64("source_name", "target_schema", "target_table", "operation", "execution_time")
    rows = rows.withColumn("lineage_id", identity)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in DATA_LINEAGE.fields])


def latest_runs(lineage: DataFrame, limit: int = 100) -> DataFrame:
    """The newest lineage rows."""
    ties = ["source_name", "target_schema", "target_table", "operation", "record_count", "status"]
    shown = [c for c in ("source_name", "source_type", "target_schema", "target_table", "operation",
                         "record_count", "execution_time", "duration_seconds", "status") if c in lineage.columns]
    return lineage.select(*shown).orderBy(F.col("execution_time").desc_nulls_first(), *ties).limit(limit)


def run_summary(lineage: DataFrame) -> DataFrame:
    """Totals per source, target and operation."""
    return (lineage.groupBy("source_name", "target_schema", "target_table", "operation")
            .agg(F.sum("record_count").alias("total_records"), F.count("*").alias("executions"),
                 F.min("execution_time").alias("first_run"), F.max("execution_time").alias("last_run"),
                 F.countDistinct("status").alias("distinct_statuses"))
            .orderBy("source_name", "target_table"))


def daily_stats(lineage: DataFrame, day: date | None = None) -> DataFrame:
    """Totals per target on one day (default: today, UTC); a range test on the time itself reaches the scan."""
    at, day = F.col("execution_time"), day or datetime.now(timezone.utc).date()
    return (lineage.filter((at >= F.lit(str(day)).cast("timestamp"))
                           & (at < F.lit(str(day + timedelta(days=1))).cast("timestamp")))
            .groupBy("target_schema", "target_table")
            .agg(F.sum("record_count").alias("total_records"), F.count("*").alias("executions"))
            .orderBy("target_schema", "target_table"))
