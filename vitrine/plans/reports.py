"""Report tables over raw listings and marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.derive import mean2
from ..functions.text import brl
from ..operators.quantiles import box_stats, histogram, quantiles
from ..sources.catalog import Warehouse, row_counts

# Display name and category rule per shop (own column or None, then the default).
DISPLAY = {"books": ("Books", "category", "Livros"), "amazon": ("Amazon", None, "Amazon"),
           "americanas": ("Americanas", "category", "Geral"), "kabum": ("KaBuM", None, "KaBuM")}
DISPLAY_NAMES = tuple(d[0] for d in DISPLAY.values())


def all_listings(raw: dict[str, DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """The raw rows of all shops under display names; a category column a shop has is used as it is."""
    def part(shop: str, df: DataFrame) -> DataFrame:
        label, own, default = DISPLAY[shop]
        category = F.col(own) if own and own in df.columns else F.lit(default)
        return df.select(F.col("product_id").cast("string").alias("product_id"), "name",
                         F.col("price").cast("double").alias("price"), F.lit(label).alias("source"), "scraped_at",
                         category.alias("category"), *keep)

    return reduce(DataFrame.unionByName, [part(shop, df) for shop, df in raw.items()])


def filtered(listings: DataFrame, sources: list[str] | None = None, low: float | None = None,
             high: float | None = None) -> DataFrame:
    """Listings of the given sources with a price between the bounds; one without a price never passes. The
    default bounds (`price_bounds`) enclose every price, so only given ones filter."""
    price = F.col("price")
    kept = listings.filter(price.isNotNull())
    if sources is not None:
        kept = kept.filter(F.col("source").isin(*sources))
    if low is not None:
        kept = kept.filter(price >= low)
    return kept if high is None else kept.filter(price <= high)


def price_bounds(listings: DataFrame) -> DataFrame:
    """The default price bounds: NULL prices count as 0, no rows give 0 and 1000."""
    filled = F.coalesce(F.col("price"), F.lit(0.0))
    return listings.agg(F.coalesce(F.min(filled), F.lit(0.0)).alias("price_min"),
                        F.coalesce(F.max(filled), F.lit(1000.0)).alias("price_max"))


def sources(listings: DataFrame) -> DataFrame:
    return listings.select("source").distinct()


# Notebook-style reports over one table.

def price_by_source(table: DataFrame) -> DataFrame:
    return (table.groupBy("source").agg(
        F.count("*").alias("count"), mean2(F.col("price")).alias("avg_price"),
        F.round(F.min("price"), 2).alias("min_price"), F.round(F.max("price"), 2).alias("max_price"))
        .orderBy(F.col("avg_price").desc_nulls_first(), "source"))


def by_category_and_source(books: DataFrame) -> DataFrame:
    return (books.groupBy("category", "source").agg(
        F.count("*").alias("count"), mean2(F.col("price")).alias("avg_price"), mean2(F.col("rating")).alias("avg_rating"))
        .orderBy(F.col("avg_price").desc_nulls_first(), "category", "source"))


def by_source_and_tier(products: DataFrame) -> DataFrame:
    return (products.groupBy("source", "price_tier").agg(
        F.count("*").alias("count"), mean2(F.col("price")).alias("avg_price"),
        mean2(F.col("discount_percentage")).alias("avg_discount"))
        .orderBy("source", "price_tier"))


def filtered_price_by_source(table: DataFrame, above: float = 0, below: float = 100) -> DataFrame:
    return (table.filter((F.col("price") > above) & (F.col("price") < below)).groupBy("source")
            .agg(mean2(F.col("price")).alias("avg_price"), F.count("*").alias("count")))


def volume_comparison(raw: dict[str, DataFrame]) -> DataFrame:
    """Listings with a positive price and their mean price per shop."""
    parts = [df.filter(F.col("price") > 0).agg(F.count("*").alias("count"), mean2(F.col("price")).alias("avg_price"))
             .select(F.lit(shop).alias("source"), "count", "avg_price") for shop, df in raw.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(F.col("count").desc(), "source")


def ratings_comparison(raw: dict[str, DataFrame]) -> DataFrame:
    """Mean rating and rated listings per shop; a shop without ratings counts all listings, its mean is NULL."""
    def part(shop: str, df: DataFrame) -> DataFrame:
        if "rating" in df.columns:
            rated = df.filter(F.col("rating").isNotNull())
            return rated.agg(mean2(F.col("rating").cast("double")).alias("avg_rating"),
                             F.count("*").alias("review_count")).withColumn("source", F.lit(shop))
        return df.agg(F.count("*").alias("review_count")).withColumn("source", F.lit(shop))

    parts = [part(shop, df) for shop, df in raw.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.select("source", "avg_rating", "review_count").orderBy(F.col("avg_rating").desc_nulls_last(), "source")


def run_report(raw: dict[str, DataFrame], marts: dict[str, DataFrame]) -> DataFrame:
    """All row counts and the mean book price in one row."""
    counts = row_counts({**{f"raw_{n}": d for n, d in raw.items()}, **marts})
    names = [f"raw_{n}" for n in raw] + list(marts)
    wide = counts.groupBy().pivot("table_name", names).sum("n")
    mean = raw["books"].agg(mean2(F.col("price"))).scalar()
    return wide.select(*names, mean.alias("avg_price_books"))


# Dashboard tables over the union of all listings.

def kpis(listings: DataFrame) -> DataFrame:
    return listings.agg(
        F.count("*").alias("total_products"), F.avg("price").alias("avg_price"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.countDistinct("source").alias("active_sources"),
        F.max("scraped_at").alias("last_scraped"))


def kpi_texts(listings: DataFrame) -> DataFrame:
    """The key figures with prices as currency text."""
    shown = {c: brl(F.col(c)) for c in ("avg_price", "min_price", "max_price")}
    return kpis(listings).withColumns(shown)


def volume_by_source(listings: DataFrame) -> DataFrame:
    """Listings per source and their share of the total."""
    per_source = listings.groupBy("source").agg(F.count("*").alias("products"))
    total = F.sum("products").over(W.partitionBy())  # over one row per source
    return per_source.withColumn("share", F.round(F.col("products") / total, 6))


def timeline(listings: DataFrame) -> DataFrame:
    return (listings.groupBy(F.to_date("scraped_at").alias("scraped_date"), "source")
            .agg(F.count("*").alias("count")).filter("scraped_date is not null"))


def price_stats(listings: DataFrame) -> DataFrame:
    """Count, mean, median, minimum and maximum of the price per source."""
    plain = listings.groupBy("source").agg(
        F.count("price").alias("count"), F.avg("price").alias("mean"), F.min("price").alias("min"),
        F.max("price").alias("max"))
    middle = quantiles(listings, "source", "price", (0.5,)).select(F.col("source"), F.col("q0").alias("median"))
    joined = plain.join(middle, "source", "left")
    return joined.select("source", "count", *[F.round(c, 2).alias(c) for c in ("mean", "median", "min", "max")])


def price_box(listings: DataFrame) -> DataFrame:
    return box_stats(listings, "source", "price")


def price_histogram(listings: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(listings, "price", bins)


def avg_price(listings: DataFrame) -> DataFrame:
    return listings.groupBy("source").agg(F.avg("price").alias("price"))


def most_expensive(listings: DataFrame, n: int = 10, tiebreak: list[Column] | None = None) -> DataFrame:
    ties = tiebreak or [F.col("source"), F.col("name")]
    return (listings.filter(F.col("price").isNotNull()).orderBy(F.col("price").desc(), *ties).limit(n)
            .select("name", "price", "source"))


def largest_categories(listings: DataFrame, n: int = 10) -> DataFrame:
    return (listings.filter(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("count"))
            .orderBy(F.col("count").desc(), "category").limit(n))


def dearest_categories(listings: DataFrame, n: int = 10) -> DataFrame:
    return (listings.filter(F.col("category").isNotNull()).groupBy("category").agg(F.avg("price").alias("avg_price"))
            .orderBy(F.col("avg_price").desc_nulls_last(), "category").limit(n))


def price_sample(listings: DataFrame, n: int = 500, seed: int | None = None) -> DataFrame:
    """Up to `n` listings in the order of a seeded hash of their values: the same sample of the same listings."""
    values = [F.coalesce(F.col("product_id").cast("string"), F.lit("")), F.coalesce("source", F.lit("")),
              F.coalesce(F.unix_micros(F.col("scraped_at").cast("timestamp")).cast("string"), F.lit(""))]
    ties = [c for c in listings.columns if c.startswith("seq_")]
    mixed = F.md5(F.concat_ws("|", F.lit(str(seed)), *values, *(F.col(c).cast("string") for c in ties)))
    return listings.orderBy(mixed).limit(n).select("price", "source")


def category_matrix(listings: DataFrame, names: tuple[str, ...] = DISPLAY_NAMES) -> DataFrame:
    """Mean price, a row per category and a column per source; 0 where there is none."""
    return (listings.filter(F.col("category").isNotNull() & F.col("price").isNotNull())
            .groupBy("category").pivot("source", list(names)).agg(F.avg("price")).na.fill(0.0))


def currency_table(table: DataFrame) -> DataFrame:
    """A table with its price as currency text."""
    return table.withColumn("price", brl(F.col("price").cast("double")))


def cdc_columns(shops: tuple[str, ...], spark) -> DataFrame:
    return spark.createDataFrame([(f"raw.{s}", "updated_at, deleted_at, _extract_ts") for s in shops],
                                 "table_name string, cdc_columns string")


def dashboard(house: Warehouse, raw: dict[str, DataFrame], sources: list[str] | None = None,
              low: float | None = None, high: float | None = None, seed: int = 0) -> dict[str, str]:
    """Write every dashboard table to `report`. The filtered listings are written once and the others read them
    with only the columns each needs."""
    house.replace("report.listings", filtered(all_listings(raw), sources, low, high))
    listings = house.read("report.listings")
    tables = {
        "kpis": kpi_texts(listings), "volume": volume_by_source(listings), "timeline": timeline(listings),
        "price_stats": price_stats(listings), "price_box": price_box(listings),
        "price_histogram": price_histogram(listings), "avg_price": avg_price(listings),
        "most_expensive": currency_table(most_expensive(listings)), "sample": price_sample(listings, seed=seed),
        "largest_categories": largest_categories(listings), "dearest_categories": dearest_categories(listings),
        "category_matrix": category_matrix(listings),
    }
    for shop, df in raw.items():
        tables[f"raw_{shop}_brl"] = currency_table(df)
    for mart in ("dim_products", "dim_books"):
        if house.exists(f"marts.{mart}"):
            tables[f"{mart}_brl"] = currency_table(house.read(f"marts.{mart}"))
    for name, df in tables.items():
        house.replace(f"report.{name}", df)
    return {name: house.name(f"report.{name}") for name in ["listings", *tables]}
