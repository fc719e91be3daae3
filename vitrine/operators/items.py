"""Clean, validate and deduplicate scraped items."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (ISO_LAYOUT, category_name, clean_price, number, present, rating_number,
                              source_address, strip, title_case)
from .dedup import first_per_item

# Fields an item must have.
REQUIRED_FIELDS = ("product_id", "name", "price")


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.simpleString() == "string"


def clean_items(df: DataFrame, run_time: datetime) -> DataFrame:
    """Normalise name, category, rating, price, time and source where the item has them."""
    changes: dict[str, Column] = {}
    if "name" in df.columns:
        changes["name"] = title_case(strip(F.col("name")))
    if "category" in df.columns:
        changes["category"] = category_name(F.col("category"))
    if "rating" in df.columns:
        changes["rating"] = rating_number(F.col("rating"))
    if "price" in df.columns:
        price = F.col("price")
        changes["price"] = clean_price(price) if _is_text(df, "price") else F.round(price.cast("double"), 2)
    if "scraped_at" in df.columns:
        now = run_time.strftime("%Y-%m-%dT%H:%M:%S")
        kept = F.col("scraped_at")
        if _is_text(df, "scraped_at"):
            changes["scraped_at"] = F.when(present(kept), kept).otherwise(F.lit(now))
        else:
            changes["scraped_at"] = F.coalesce(kept, F.to_timestamp(F.lit(now), ISO_LAYOUT))
    if "source" in df.columns:
        changes["source"] = source_address(F.col("source"))
    return df.withColumns(changes)


def reject_reason(df: DataFrame) -> Column:
    """Why an item is refused, NULL for a valid one."""
    price = F.col("price")
    text_price = _is_text(df, "price")
    amount = number(price) if text_price else price.cast("double")

    def absent(name: str) -> Column:
        if name == "price" and not text_price:
            return F.coalesce(price == 0, F.lit(True))
        return ~present(F.col(name).cast("string"))

    missing = F.array_compact(F.array(*[F.when(absent(n), F.lit(n)) for n in REQUIRED_FIELDS]))
    return (F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
            .when(amount.isNull(), F.lit("price is not a number"))
            .when(amount <= 0, F.lit("price is not positive")))


def valid_items(df: DataFrame) -> DataFrame:
    return df.filter(reject_reason(df).isNull())


def rejected_items(df: DataFrame) -> DataFrame:
    """The refused items with the reason, for a side output."""
    return df.withColumn("reject_reason", reject_reason(df)).filter("reject_reason is not null")


def item_chain(df: DataFrame, run_time: datetime, arrival: list[str], validate: bool = True) -> DataFrame:
    """Clean, validate (shops with trusted payloads skip this) and keep the first of each item."""
    cleaned = clean_items(df, run_time)
    return first_per_item(valid_items(cleaned), arrival, all_have_id=True) if validate else first_per_item(cleaned, arrival)
