"""Marts to report tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.catalog import Warehouse
from ..sources.files import write_csv, write_json

# The marts that are published.
PUBLISHED = ("dim_books", "dim_products")


def to_report(house: Warehouse, table: str, source: str = "marts", target: str = "report") -> int:
    """Replace the report copy of a table; returns its row count (from the file footers)."""
    house.replace(f"{target}.{table}", house.read(f"{source}.{table}"))
    return house.count(f"{target}.{table}")


def to_csv(house: Warehouse, table: str, output_dir: str, schema: str = "marts") -> int:
    write_csv(house.read(f"{schema}.{table}"), f"{output_dir}/{table}.csv")
    return house.count(f"{schema}.{table}")


def to_json(house: Warehouse, table: str, output_dir: str, schema: str = "marts") -> int:
    write_json(house.read(f"{schema}.{table}"), f"{output_dir}/{table}.json")
    return house.count(f"{schema}.{table}")


def all_to_report(house: Warehouse) -> dict[str, int]:
    return {t: to_report(house, t) for t in PUBLISHED}


def all_to_csv(house: Warehouse, output_dir: str) -> dict[str, int]:
    return {t: to_csv(house, t, output_dir) for t in PUBLISHED}


def all_to_json(house: Warehouse, output_dir: str) -> dict[str, int]:
    return {t: to_json(house, t, output_dir) for t in PUBLISHED}


def export_report(report: DataFrame, path: str) -> None:
    """The one-row health report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
