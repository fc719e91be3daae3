"""Listings out of nested JSON payloads, one payload per row in column `body`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import present
from ..operators.dedup import first_rows
from ..schemas import KABUM_PAYLOAD, VTEX_PAYLOAD


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _products(payloads: DataFrame, array: Column) -> DataFrame:
    """One row per array element. The array stays an expression inside the generator: as a column of its own, the
    optimizer would infer filters on it and parse every payload again for them."""
    kept = [c for c in payloads.columns if c != "body"]
    return payloads.select(*kept, F.posexplode(array).alias("pos", "p"))


def vtex_listings(payloads: DataFrame) -> DataFrame:
    """A JSON list of products to listings; other or broken payloads give no rows."""
    body = F.when(F.col("body").rlike(r"^\s*\["), F.col("body"))
    rows = _products(payloads, F.from_json(body, VTEX_PAYLOAD))
    kept = [c for c in rows.columns if c != "p"]
    offered = (rows.withColumn("item", F.get("p.items", F.lit(0)))
               .withColumn("seller", F.coalesce(F.get(F.filter("item.sellers", lambda s: s.sellerDefault), F.lit(0)),
                                                F.get("item.sellers", F.lit(0)))))
    link = F.col("p.linkText")
    listings = offered.select(
        *kept,
        _text(F.col("p.productId")).alias("product_id"),
        _text(F.col("p.productName")).alias("name"),
        _text(F.col("p.brand")).alias("brand"),
        _zero(F.col("seller.commertialOffer.Price")).alias("price"),
        _zero(F.col("seller.commertialOffer.ListPrice")).alias("list_price"),
        _zero(F.col("seller.commertialOffer.AvailableQuantity")).alias("available_quantity"),
        _text(F.regexp_replace(F.get("p.categories", F.lit(0)), "^/+|/+$", "")).alias("category"),
        _text(F.get("item.images", F.lit(0)).imageUrl).alias("image_url"),
        F.when(present(link), F.concat(F.lit("https://www.americanas.com.br/"), link, F.lit("/p")))
        .otherwise("").alias("url"),
        _text(F.col("seller.sellerName")).alias("seller"),
        F.lit("americanas").alias("source"))
    return listings.filter(present(F.col("name")) & present(F.col("product_id")))


def kabum_listings(payloads: DataFrame) -> DataFrame:
    """A `{meta, data}` payload to listings; products without a title and broken payloads give no rows."""
    rows = _products(payloads, F.from_json("body", KABUM_PAYLOAD).data).filter(present(F.col("p.attributes.title")))
    kept = [c for c in rows.columns if c != "p"]
    a = F.col("p.attributes")
    menu, market = a.menu, a.marketplace.seller_name
    return rows.select(
        *kept,
        _text(F.col("p.id").cast("string")).alias("product_id"),
        a.title.alias("name"),
        _text(a.manufacturer["name"]).alias("brand"),
        _zero(F.coalesce(F.nullif(a.price_with_discount, F.lit(0.0)), a.price)).alias("price"),
        _zero(a.old_price).alias("old_price"),
        _zero(a.discount_percentage).alias("discount_percentage"),
        _zero(a.stock).alias("stock"),
        _text(F.substring_index(menu, "/", -1)).alias("category"),
        _text(F.get(a.images, F.lit(0))).alias("image_url"),
        F.when(present(a.product_link),
               F.concat(F.lit("https://www.kabum.com.br/produto/"), F.col("p.id").cast("string")))
        .otherwise("").alias("url"),
        F.when(present(market), market).otherwise("KaBuM").alias("seller"),
        _zero(a.average_of_ratings).alias("rating"),
        _zero(a.number_of_ratings).alias("reviews_count"),
        F.lit("kabum").alias("source"))


def capped(listings: DataFrame, groups: list[str], order: list[str], limit: int) -> DataFrame:
    """At most `limit` listings per source and query, in page and position order."""
    return first_rows(listings, groups, order, limit)
