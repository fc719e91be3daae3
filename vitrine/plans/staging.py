"""Raw tables to staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.derive import as_count, as_number, rating_label
from ..functions.text import rating_number
from ..operators.dedup import newest_per_key

# Per shop the columns read as numbers and as counts (default 0).
NUMBERS = {"amazon": ("price", "original_price", "rating"), "americanas": ("price", "list_price"),
           "kabum": ("price", "old_price", "rating")}
COUNTS = {"amazon": ("reviews_count",), "americanas": ("available_quantity",), "kabum": ("stock", "reviews_count")}


def stg_books(raw: DataFrame) -> DataFrame:
    """Rating words and numbers as numbers, plus the rating label."""
    text_rating = raw.schema["rating"].dataType.simpleString() == "string"
    rating = as_number(raw, "rating")
    if text_rating:
        rating = F.coalesce(rating, rating_number(F.col("rating")).cast("double"))
    return (raw.withColumns({"product_id": F.col("product_id").cast("string"), "price": as_number(raw, "price"),
                             "rating": rating})
            .withColumn("rating_label", rating_label(F.col("rating"))))


def stg_shop(raw: DataFrame, shop: str) -> DataFrame:
    """Prices and ratings as numbers, counts as whole numbers with default 0, the shop as source."""
    return raw.withColumns({
        "product_id": F.col("product_id").cast("string"),
        **{c: as_number(raw, c) for c in NUMBERS[shop]},
        **{c: as_count(raw, c) for c in COUNTS[shop]},
        "source": F.lit(shop)})


def staging(raw: DataFrame, shop: str) -> DataFrame:
    """A shop's staging rows, one per product: the newest raw row of each product id."""
    newest = newest_per_key(raw, ["product_id"])
    return stg_books(newest) if shop == "books" else stg_shop(newest, shop)
