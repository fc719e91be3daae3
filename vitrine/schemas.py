"""Row types, table definitions and the fixed source list."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The four shops with raw tables, in load order.
SHOPS = ("books", "amazon", "americanas", "kabum")

# Change-data-capture columns.
CDC_COLUMNS = ("updated_at", "_extract_ts", "deleted_at")


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
          "timestamp": T.TimestampType(), "date": T.DateType(), "decimal(10,2)": T.DecimalType(10, 2),
          "decimal(3,1)": T.DecimalType(3, 1)}


def struct(**fields: str) -> T.StructType:
    """`struct(id="bigint", name="string")` as a nullable StructType."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields.items()])


_CDC = dict(updated_at="timestamp", deleted_at="timestamp", _extract_ts="timestamp")
_AUDIT = dict(created_at="timestamp", **_CDC)

RAW_BOOKS = struct(
    product_id="string", name="string", price="decimal(10,2)", rating="int", availability="string",
    image_url="string", url="string", category="string", source="string", scraped_at="timestamp", **_CDC)

RAW_AMAZON = struct(
    product_id="string", name="string", price="decimal(10,2)", original_price="decimal(10,2)",
    rating="decimal(3,1)", reviews_count="int", image_url="string", url="string", source="string",
    scraped_at="timestamp", **_CDC)

RAW_AMERICANAS = struct(
    product_id="string", name="string", brand="string", price="decimal(10,2)", list_price="decimal(10,2)",
    available_quantity="int", category="string", image_url="string", url="string", seller="string",
    source="string", scraped_at="timestamp", **_CDC)

RAW_KABUM = struct(
    product_id="string", name="string", brand="string", price="decimal(10,2)", old_price="decimal(10,2)",
    discount_percentage="int", stock="int", category="string", image_url="string", url="string",
    seller="string", rating="decimal(3,1)", reviews_count="int", source="string", scraped_at="timestamp", **_CDC)

RAW_CUSTOMERS = struct(
    customer_id="bigint", first_name="string", last_name="string", email="string", phone="string",
    city="string", state="string", **_AUDIT)

RAW_PRODUCTS = struct(
    product_id="bigint", name="string", category="string", price="decimal(10,2)", stock_quantity="int", **_AUDIT)

RAW_ORDERS = struct(
    order_id="bigint", customer_id="bigint", order_date="date", status="string", total_amount="decimal(10,2)",
    shipping_address="string", **_AUDIT)

RAW_ORDER_ITEMS = struct(
    order_item_id="bigint", order_id="bigint", product_id="bigint", quantity="int",
    unit_price="decimal(10,2)", _extract_ts="timestamp")

DATA_LINEAGE = struct(
    lineage_id="bigint", source_name="string", source_type="string", target_schema="string",
    target_table="string", operation="string", record_count="bigint", execution_time="timestamp",
    duration_seconds="decimal(10,2)", status="string", error_message="string", checksum="string",
    parent_lineage_id="bigint")

CHANGE_TRACKING = struct(
    tracking_id="bigint", source_table="string", source_key="string", operation="string",
    changed_at="timestamp", extracted_at="timestamp", loaded_at="timestamp")

CHECK_RESULT = struct(stage="string", test="string", status="string", message="string")
HEALTH_CHECK = struct(check="string", passed="boolean", level="string", message="string")


@dataclass(frozen=True)
class TableDef:
    """Columns, business key, parents (child column to parent table and column) and text limits of a table."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    limits: dict[str, int] = field(default_factory=dict)


_SHOP_LIMITS = dict(product_id=50, name=500)

TABLES: dict[str, TableDef] = {
    "raw.books": TableDef(RAW_BOOKS, ("product_id", "source"),
                          limits=dict(_SHOP_LIMITS, availability=100, category=100)),
    "raw.amazon": TableDef(RAW_AMAZON, ("product_id", "source"), limits=dict(_SHOP_LIMITS, source=50)),
    "raw.americanas": TableDef(RAW_AMERICANAS, ("product_id", "source"),
                               limits=dict(_SHOP_LIMITS, brand=200, category=500, seller=200, source=50)),
    "raw.kabum": TableDef(RAW_KABUM, ("product_id", "source"),
                          limits=dict(_SHOP_LIMITS, brand=200, category=500, seller=200, source=50)),
    "raw.customers": TableDef(RAW_CUSTOMERS, ("customer_id",),
                              limits=dict(first_name=100, last_name=100, email=255, phone=20, city=100, state=50)),
    "raw.products": TableDef(RAW_PRODUCTS, ("product_id",), limits=dict(name=255, category=100)),
    "raw.orders": TableDef(RAW_ORDERS, ("order_id",), {"customer_id": ("raw.customers", "customer_id")},
                           limits=dict(status=50)),
    "raw.order_items": TableDef(RAW_ORDER_ITEMS, ("order_item_id",),
                                {"order_id": ("raw.orders", "order_id"),
                                 "product_id": ("raw.products", "product_id")}),
    "lineage.data_lineage": TableDef(DATA_LINEAGE, ("lineage_id",),
                                     limits=dict(source_name=100, source_type=50, target_schema=50,
                                                 target_table=100, operation=50, status=20, checksum=64)),
    "lineage.change_tracking": TableDef(CHANGE_TRACKING, ("tracking_id",),
                                        limits=dict(source_table=100, source_key=255, operation=20)),
}

STAGING_KEY = ("product_id",)
MART_KEYS = {"marts.dim_books": ("book_id",), "marts.dim_products": ("id",)}


def drop_schema(shop: str) -> T.StructType:
    """Read schema of a shop's drop files: numbers and times stay text here and are coerced after the read."""
    plain = {"string"}
    return T.StructType([
        T.StructField(f.name, f.dataType if f.dataType.simpleString() in plain else T.StringType())
        for f in TABLES[f"raw.{shop}"].schema
    ])


# Nested payload of the catalogue search API that answers with a JSON list of products.
VTEX_PAYLOAD = """
array<struct<
  productId:string, productName:string, brand:string, categories:array<string>, linkText:string,
  items:array<struct<
    images:array<struct<imageUrl:string>>,
    sellers:array<struct<sellerDefault:boolean, sellerName:string,
      commertialOffer:struct<Price:double, ListPrice:double, AvailableQuantity:int>>>>>>>
"""

# Nested payload of the catalogue API that answers with `{meta, data: [...]}`.
KABUM_PAYLOAD = """
struct<meta:struct<total_items_count:int>, data:array<struct<id:bigint, attributes:struct<
  title:string, price:double, price_with_discount:double, old_price:double, discount_percentage:int,
  stock:int, menu:string, images:array<string>, product_link:string, manufacturer:struct<name:string>,
  marketplace:struct<seller_name:string>, average_of_ratings:double, number_of_ratings:int>>>>
"""
