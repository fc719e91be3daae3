"""Staging tables to the book and product dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.derive import against_average, as_number, book_key, discount_percent, listing_key, price_tier
from ..operators.dedup import newest_per_key
from ..session import stored

# Column that holds the price before discount, per shop.
ORIGINAL_PRICE = {"amazon": "original_price", "americanas": "list_price", "kabum": "old_price"}
LISTING_TEXTS = ("brand", "category", "seller", "image_url", "url")
BOOK_COLUMNS = ("book_id", "product_id", "book_name", "price", "rating", "rating_label", "availability",
                "image_url", "url", "category", "source", "scraped_at", "price_vs_category")
PRODUCT_COLUMNS = ("id", "product_id", "product_name", "brand", "price", "original_price", "discount_percentage",
                   "category", "seller", "image_url", "url", "source", "price_tier", "scraped_at")


def _own(df: DataFrame, name: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast("string").alias(name)


def category_average(books: DataFrame) -> DataFrame:
    """Mean price per category; rows without a category belong to none."""
    return (books.filter(F.col("category").isNotNull()).groupBy("category")
            .agg(F.avg("price").alias("avg_category_price")))


def dim_books(books: DataFrame, tiebreak: list[Column] | None = None) -> DataFrame:
    """Books with their price against the category average over all rows, then the newest row per product.

    The averages are written first: their true size decides between a broadcast and a shuffle join, and in the
    latter AQE splits a hot category.
    """
    average = stored(category_average(books), "category-average")
    priced = books.join(average, "category", "left")
    newest = newest_per_key(priced, ["product_id"], tiebreak)
    return newest.withColumns({
        "book_id": book_key(F.col("product_id")), "book_name": F.col("name"),
        "price_vs_category": against_average(F.col("price"), F.col("avg_category_price")),
        **{c: _own(newest, c) for c in ("availability", "image_url", "url")},
    }).select(*BOOK_COLUMNS)


def prepare_source(df: DataFrame, source: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A shop's rows in the common listing columns; text columns it lacks are NULL, a missing original price 0."""
    name = "name" if "name" in df.columns else "product_name"
    original = as_number(df, ORIGINAL_PRICE.get(source, "original_price"))
    return df.select(
        F.col("product_id").cast("string").alias("product_id"), F.col(name).alias("product_name"),
        as_number(df, "price").alias("price"), F.coalesce(original, F.lit(0.0)).alias("original_price"),
        *[_own(df, c) for c in LISTING_TEXTS], F.lit(source).alias("source"), F.col("scraped_at"), *keep)


def valid_listings(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("product_name").isNotNull() & (F.col("price") > 0))


def finish_products(listings: DataFrame, tiebreak: list[Column] | None = None) -> DataFrame:
    """The newest valid row per product and source with discount, tier and id. The derived columns come after
    the shuffle, so it carries only what they are made from."""
    newest = newest_per_key(valid_listings(listings), ["product_id", "source"], tiebreak)
    return newest.withColumns({
        "discount_percentage": discount_percent(F.col("price"), F.col("original_price")),
        "price_tier": price_tier(F.col("price")),
        "id": listing_key(F.col("product_id"), F.col("source")),
    }).select(*PRODUCT_COLUMNS)


def dim_products(sources: dict[str, DataFrame], tiebreak: list[Column] | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    prepared = [prepare_source(df, name, keep) for name, df in sources.items()]
    return finish_products(reduce(DataFrame.unionByName, prepared), tiebreak)
