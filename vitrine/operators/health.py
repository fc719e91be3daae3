"""Health checks of the tables, alert rows and the summary."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import HEALTH_CHECK, SHOPS

# Limits of the full check, share of passed checks that still counts as degraded, alert texts.
RAW_MAX_HOURS = 48
RAW_MIN_ROWS = 10
DEGRADED_SHARE = 0.8
MART_KEYS = (("dim_products", "id"), ("dim_books", "book_id"))
MISSING = "Tabela {t} nao existe"
EMPTY = "Tabela {t} esta vazia"
NO_TIME = "Tabela {t} sem dados de scraped_at"
LATE = "Dados de {t} estao %.1fh atrasados (max: {m}h)"
FEW = "Tabela {t} tem apenas %d linhas (minimo: {m})"
DOUBLE = "Tabela {t} tem %d duplicatas em {c}"


def _row(check: str, passed: Column, message: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), passed.alias("passed"), F.lit("WARNING").alias("level"),
                    F.when(~passed, message).alias("message"))


def freshness(df: DataFrame, as_of: datetime, time: str = "scraped_at") -> DataFrame:
    """Latest time and the hours from it to `as_of`."""
    return df.agg(F.max(time).alias("last_scraped")).withColumn(
        "hours", _hours(F.col("last_scraped"), as_of))


def _hours(last: Column, as_of: datetime) -> Column:
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    return (now.cast("double") - last.cast("timestamp").cast("double")) / 3600


def _gone(spark: SparkSession, table: str, checks: list[str]) -> DataFrame:
    return spark.createDataFrame([(c, False, "WARNING", MISSING.format(t=table)) for c in checks], HEALTH_CHECK)


def table_checks(spark: SparkSession, table: str, df: DataFrame | None, as_of: datetime,
                 max_hours: float = RAW_MAX_HOURS, min_rows: int = RAW_MIN_ROWS, time: str = "scraped_at") -> DataFrame:
    """Existence, rows, freshness and minimum size of any table in one scan; one without the time column is fresh."""
    names = [f"{table.replace('.', '_')}_{c}" for c in ("exists", "not_empty", "freshness", "min_rows")]
    if df is None:
        return _gone(spark, table, names)
    timed = time in df.columns
    last = F.max(time) if timed else F.lit(None).cast("timestamp")
    n, hours = F.col("n"), _hours(F.col("last"), as_of)
    fresh = F.coalesce(hours <= max_hours, F.lit(False)) if timed else F.lit(True)
    stale = F.when(F.col("last").isNull(), NO_TIME.format(t=table)).otherwise(
        F.format_string(LATE.format(t=table, m=max_hours), hours))
    return df.agg(F.count("*").alias("n"), last.alias("last")).select(F.inline(F.array(
        _row(names[0], F.lit(True), F.lit("")), _row(names[1], n > 0, F.lit(EMPTY.format(t=table))),
        _row(names[2], fresh, stale),
        _row(names[3], n >= min_rows, F.format_string(FEW.format(t=table, m=min_rows), n)))))


def raw_checks(spark: SparkSession, shop: str, df: DataFrame | None, as_of: datetime,
               max_hours: float = RAW_MAX_HOURS, min_rows: int = RAW_MIN_ROWS) -> DataFrame:
    return table_checks(spark, f"raw.{shop}", df, as_of, max_hours, min_rows)


def mart_checks(spark: SparkSession, table: str, key: str, df: DataFrame | None, schema: str = "marts") -> DataFrame:
    """Existence, rows and unique key of a table; the key counts also give the row count."""
    full, names = f"{schema}.{table}", [f"{table}_{c}" for c in ("exists", "not_empty", "unique_id")]
    if df is None:
        return _gone(spark, full, names)
    keys = df.groupBy(key).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count_if(F.col("count") > 1).alias("d"))
    return keys.select(F.inline(F.array(
        _row(names[0], F.lit(True), F.lit("")), _row(names[1], F.col("n") > 0, F.lit(EMPTY.format(t=full))),
        _row(names[2], F.col("d") == 0, F.format_string(DOUBLE.format(t=full, c=key), F.col("d"))))))


def full_check(spark: SparkSession, resolve: Callable[[str], DataFrame | None], as_of: datetime) -> DataFrame:
    """22 check rows (check, passed, level, message)."""
    parts = [raw_checks(spark, s, resolve(f"raw.{s}"), as_of) for s in SHOPS]
    parts += [mart_checks(spark, t, key, resolve(f"marts.{t}")) for t, key in MART_KEYS]
    return reduce(DataFrame.unionByName, parts)


def alerts(checks: DataFrame, as_of: datetime) -> DataFrame:
    """One alert per failed check."""
    stamp = F.lit(as_of.strftime("%Y-%m-%dT%H:%M:%S"))
    return checks.filter(~F.col("passed")).select("level", "message", stamp.alias("timestamp"))


def summary(checks: DataFrame) -> DataFrame:
    """Passed and total checks and the overall status in one row."""
    passed, total = F.col("passed"), F.col("total")
    status = (F.when(passed == total, "healthy").when(passed >= total * DEGRADED_SHARE, "degraded")
              .otherwise("unhealthy"))
    return (checks.agg(F.count_if("passed").alias("passed"), F.count("*").alias("total"))
            .withColumn("status", status))


def report(checks: DataFrame, as_of: datetime, elapsed_seconds: float = 0.0) -> DataFrame:
    """The health report as one row: time, status, counts, all checks and the alerts. The check list is fixed, so
    the row is small."""
    rows = checks.select("check", "passed", "level", "message")
    stamp = as_of.strftime("%Y-%m-%dT%H:%M:%S")
    lists = rows.agg(
        F.collect_list(F.struct("check", "passed")).alias("checks"),
        F.array_compact(F.collect_list(F.when(~F.col("passed"), F.struct(
            "level", "message", F.lit(stamp).alias("timestamp"))))).alias("alerts"),
        F.count_if("passed").alias("passed"), F.count("*").alias("total"))
    status = (F.when(F.col("passed") == F.col("total"), "healthy")
              .when(F.col("passed") >= F.col("total") * DEGRADED_SHARE, "degraded").otherwise("unhealthy"))
    return lists.select(F.lit(stamp).alias("timestamp"), status.alias("status"), "passed", "total",
                        F.lit(elapsed_seconds).alias("elapsed_seconds"), "checks", "alerts")
