"""Staging and marts written to their tables by keyed merges."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..schemas import SHOPS
from ..session import in_parallel
from ..sources.catalog import Warehouse
from . import marts, staging
from .raw_load import upsert_table

# Columns whose NULLs are reported as warnings.
REQUIRED = {"staging": ("product_id", "name"), "dim_books": ("book_id", "book_name", "price"),
            "dim_products": ("id", "product_name", "price")}


def _since(df: DataFrame, since: datetime | None) -> DataFrame:
    if since is None:
        return df
    return df.filter(F.col("_extract_ts") > F.lit(since.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp"))


def transform_staging(house: Warehouse, shop: str, run_time: datetime, since: datetime | None = None,
                      warnings: list[str] | None = None) -> int:
    """One shop's raw rows into its staging table. With `since` only the products that have rows extracted after that
    time are staged, each from all its raw rows: the newest of them may be an older extract."""
    raw = house.read(f"raw.{shop}")
    if since is not None:
        raw = raw.join(_since(raw, since).select("product_id").distinct(), "product_id", "left_semi")
    rows = staging.staging(raw, shop)
    return upsert_table(house, f"staging.stg_{shop}", rows, run_time, track_changes=False,
                        required=REQUIRED["staging"], warnings=warnings)


def transform_dim_books(house: Warehouse, run_time: datetime, warnings: list[str] | None = None) -> int:
    """All books: a category's average moves with any of its books."""
    return upsert_table(house, "marts.dim_books", marts.dim_books(house.read("staging.stg_books")), run_time,
                        track_changes=False, required=REQUIRED["dim_books"], warnings=warnings)


def transform_dim_products(house: Warehouse, run_time: datetime, since: datetime | None = None,
                           warnings: list[str] | None = None) -> int:
    # Staging holds one row per product: one that an older extract still wins stands in the mart already.
    shops = {s: _since(house.read(f"staging.stg_{s}"), since) for s in marts.ORIGINAL_PRICE
             if house.exists(f"staging.stg_{s}")}
    if not shops:
        return 0
    return upsert_table(house, "marts.dim_products", marts.dim_products(shops), run_time, track_changes=False,
                        required=REQUIRED["dim_products"], warnings=warnings)


def run_staging(house: Warehouse, run_time: datetime, since: datetime | None = None,
                warnings: list[str] | None = None) -> dict[str, int]:
    counts = in_parallel(house.spark, lambda shop: transform_staging(house, shop, run_time, since, warnings), SHOPS)
    return {f"stg_{shop}": n for shop, n in zip(SHOPS, counts)}


def run_marts(house: Warehouse, run_time: datetime, since: datetime | None = None,
              warnings: list[str] | None = None) -> dict[str, int]:
    jobs = {"dim_products": lambda: transform_dim_products(house, run_time, since, warnings)}
    if house.exists("staging.stg_books"):
        jobs["dim_books"] = lambda: transform_dim_books(house, run_time, warnings)
    counts = dict(zip(jobs, in_parallel(house.spark, lambda name: jobs[name](), jobs)))
    return {"dim_books": counts.get("dim_books", 0), "dim_products": counts["dim_products"]}


def run_all(house: Warehouse, run_time: datetime, since: datetime | None = None) -> dict:
    """Staging, then marts: row counts, seconds and warnings."""
    started, warnings = time.monotonic(), []
    return {"staging": run_staging(house, run_time, since, warnings),
            "marts": run_marts(house, run_time, since, warnings),
            "elapsed_seconds": time.monotonic() - started, "warnings": warnings}


def run_sales(house: Warehouse) -> None:
    """The order branch from its raw tables; every table is rebuilt."""
    from . import sales
    orders = sales.stg_orders(house.read("raw.orders"))
    house.replace("marts.fact_orders",
                  sales.fact_orders(sales.int_order_items(orders, house.read("raw.order_items"))))
    house.replace("marts.dim_customers", sales.dim_customers(
        sales.stg_customers(house.read("raw.customers")), house.read("marts.fact_orders")))
    house.replace("marts.dim_product_sales", sales.dim_product_sales(
        sales.stg_products(house.read("raw.products")), house.read("raw.order_items")))
