"""Column functions for labels, tiers, discounts and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import number

# Rating labels (lower bound, label), then the label below all bounds and for no rating.
RATING_LABELS = ((4, "Excelente"), (3, "Bom"), (2, "Regular"))
LOWEST_RATING = "Ruim"
NO_RATING = "Sem avaliacao"

# Price tiers (upper bound, tier), then the tier above all bounds.
PRICE_TIERS = ((100, "Economico"), (500, "Medio"), (2000, "Premium"))
TOP_TIER = "Luxo"

# Customer segments (orders above, segment), then the segment of all others.
SEGMENTS = ((5, "VIP"), (1, "Recorrente"))
FIRST_SEGMENT = "Novo"


def _ladder(steps, test, last: str) -> Column:
    chain = F
    for bound, label in steps:
        chain = chain.when(test(bound), F.lit(label))
    return chain.otherwise(F.lit(last))


def rating_label(rating: Column) -> Column:
    return F.when(rating.isNull(), F.lit(NO_RATING)).otherwise(
        _ladder(RATING_LABELS, lambda b: rating >= b, LOWEST_RATING))


def price_tier(price: Column) -> Column:
    return _ladder(PRICE_TIERS, lambda b: price < b, TOP_TIER)


def customer_segment(orders: Column) -> Column:
    return _ladder(SEGMENTS, lambda b: orders > b, FIRST_SEGMENT)


def discount_percent(price: Column, original: Column) -> Column:
    lowered = (original > 0) & (original > price)
    return F.when(lowered, F.round((original - price) / original * 100, 2)).otherwise(F.lit(0.0))


def whole_discount(price: Column, original: Column) -> Column:
    """Discount in whole percent, NULL unless both prices are set."""
    both = (original > 0) & (price != 0)
    return F.when(both, F.bround((1 - price / original) * 100).cast("int"))


def against_average(price: Column, average: Column) -> Column:
    return F.when(average > 0, F.round((price - average) / average * 100, 2)).otherwise(F.lit(0.0))


def book_key(product_id: Column) -> Column:
    return F.concat(F.lit("book_"), product_id)


def listing_key(product_id: Column, source: Column) -> Column:
    return F.concat(product_id, F.lit("_"), source)


def line_total(quantity: Column, unit_price: Column) -> Column:
    return quantity * unit_price


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def mean2(value: Column) -> Column:
    return F.round(F.avg(value), 2)


def as_number(df, name: str) -> Column:
    """Column `name` as double, NULL for text that is no number; NULL typed double when the column is missing."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    if df.schema[name].dataType.simpleString() == "string":
        return number(F.col(name))
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def as_count(df, name: str) -> Column:
    """Column `name` as a whole number, 0 when missing or no number."""
    return F.coalesce(as_number(df, name).try_cast("bigint"), F.lit(0).cast("bigint"))
