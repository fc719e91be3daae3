"""Mixing sources to target weights.

Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the size of the whole corpus, in words.
No source takes more than three times its own size; what exceeds that is shared again by weight until none is above.
A document is taken floor(rate) times, and once more if a hash of the seed and the document falls below the fraction.

The corpus is reduced to one row per source; the shares are windows over those rows. The join back to the documents is
broadcast where Spark finds the table of sources small enough, and splits a hot source otherwise.

Defined results: a null text has size 0; a null source is a source of its own, the last; a source of size 0 has target
0 and rate 0; every row is drawn by id and text, so repeated rows share one draw and different texts under one id do not. Other columns pass
through `mix`. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitrine.llm.common import whole
from vitrine.session import stored

MOST = 3
SEED = "mix-1"


def size(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size). The shares are the level at which the sources fill up:
    with sources in order of capacity per weight, those before the level hold all they can, the others by weight."""
    number = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    weighed = sizes.withColumn("weight", (F.lit(1) + (number - 1) % 3).cast("long")).withColumn("most", MOST * F.col("source_size"))
    full = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before, all_ = full.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    held = F.coalesce(F.sum("most").over(before), F.lit(0))
    rest = F.sum("source_size").over(all_) - held
    open_ = F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    staged = weighed.select("*", rest.alias("rest"), open_.alias("open"))
    # The first source whose capacity is above its share leaves the level where it is for all later ones.
    fits = F.col("most") * F.col("open") > F.col("rest") * F.col("weight")
    first = staged.select("*", F.first(F.when(fits, F.struct("rest", "open")), True).over(
        full.rowsBetween(W.unboundedPreceding, 0)).alias("level"))
    share = F.col("level.rest") * F.col("weight") / F.col("level.open")
    return first.select("source", "source_size", F.coalesce(share, F.col("most").cast("double")).alias("target"))


def draw(doc_id: str, text: str, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 of id and text: different texts under one id are drawn apart."""
    value = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(value), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, size, draw, source_size, target, times (how often it is taken)."""
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size(text).alias("size"),
                               draw(doc_id, text, seed).alias("draw")), "sizes")
    found = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    wanted = found.withColumnRenamed("source", "_source")
    return sized.join(wanted, sized["source"].eqNullSafe(F.col("_source"))).drop("_source").withColumn("times", times("draw"))


def times(draw_: str) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (F.floor(rate) + F.when(F.col(draw_) < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed corpus: each document as often as its source's rate says, columns as they were."""
    sizes = docs.select(F.col(source).alias("source"), size(text).alias("size"))
    found = stored(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    drawn = docs.select(whole(docs), F.col(source).alias("from"), draw(doc_id, text, seed).alias("draw"))
    taken = drawn.join(found, F.col("from").eqNullSafe(F.col("source"))).withColumn("times", times("draw"))
    return taken.filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
