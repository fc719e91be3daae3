"""Customers, products, orders and order items to facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.derive import customer_segment, line_total, or_zero


def _pick(df: DataFrame, **renamed: str) -> DataFrame:
    """Columns under new names; a column the input lacks is NULL."""
    return df.select(*[(F.col(old) if old in df.columns else F.lit(None).cast("string")).alias(new)
                       for new, old in renamed.items()])


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def stg_customers(raw: DataFrame) -> DataFrame:
    return _pick(raw, **_same("customer_id", "first_name", "last_name", "email", "phone", "city", "state", "created_at"))


def stg_products(raw: DataFrame) -> DataFrame:
    return _pick(raw, product_id="product_id", product_name="name",
                 **_same("category", "price", "stock_quantity", "created_at"))


def stg_orders(raw: DataFrame) -> DataFrame:
    return _pick(raw, **_same("order_id", "customer_id", "order_date", "status", "total_amount", "shipping_address",
                              "created_at", "updated_at"))


def int_order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their items; an order with very many items is split by AQE's skew join."""
    return orders.join(items, "order_id").select(
        "order_id", "customer_id", "order_date", "status", "product_id", "quantity", "unit_price",
        line_total(F.col("quantity"), F.col("unit_price")).alias("total_price"), "created_at")


def fact_orders(order_items: DataFrame) -> DataFrame:
    return order_items.select("order_id", "customer_id", "product_id", "order_date", "status", "quantity",
                              "unit_price", "total_price", "created_at")


def customer_orders(facts: DataFrame) -> DataFrame:
    """Order lines, spending and first and last date per customer."""
    return facts.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("total_price").alias("total_spent"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))


def dim_customers(customers: DataFrame, facts: DataFrame) -> DataFrame:
    return customers.join(customer_orders(facts), "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "email", "phone", "city", "state",
        or_zero(F.col("total_orders")).alias("total_orders"), or_zero(F.col("total_spent")).alias("total_spent"),
        "first_order_date", "last_order_date", customer_segment(F.col("total_orders")).alias("customer_segment"))


def product_sales(items: DataFrame) -> DataFrame:
    """Lines, quantity and revenue per product."""
    return items.groupBy("product_id").agg(
        F.count("*").alias("times_sold"), F.sum("quantity").alias("total_quantity_sold"),
        F.sum(line_total(F.col("quantity"), F.col("unit_price"))).alias("total_revenue"))


def dim_product_sales(products: DataFrame, items: DataFrame) -> DataFrame:
    return products.join(product_sales(items), "product_id", "left").select(
        "product_id", "product_name", "category", "price", "stock_quantity",
        *[or_zero(F.col(c)).alias(c) for c in ("times_sold", "total_quantity_sold", "total_revenue")])
