"""What paragraph and line deduplication share: places in documents, keepers of groups, and removal of parts.

A part (paragraph or line) stands at (doc_id, text_key, no): `no` counts from 0 over the `\\n`-separated parts of the
text. Parts with one normal form have one `part_id`, the MD5 of that form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import text_key, whole
from vitrine.session import measured

PLACE = ("doc_id", "text_key", "no")
#: Places up to this many (some 60 bytes each) are broadcast to the documents; more are joined by a shuffle of both.
BROADCAST_PLACES = 1_000_000
#: The same for lists of part numbers per document, in cells of 4 bytes.
BROADCAST_CELLS = 10_000_000


def distinct_parts(parts: DataFrame, *carried: str) -> DataFrame:
    """One row per part_id: its first place (`first`), how often it occurs, and the carried columns."""
    return parts.groupBy("part_id").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("times"),
                                        *(F.first(c).alias(c) for c in carried))


def raw_parts(docs: DataFrame, places: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(part_id, part): the text at the `first` place of each row of `places` (part_id, first)."""
    each = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"),
                       F.posexplode(F.split(F.col(text), "\n", -1)).alias("no", "part"))
    wanted = places.select("part_id", *(F.col(f"first.{c}").alias(f"f_{c}") for c in PLACE))
    wanted = F.broadcast(wanted) if places.count() <= BROADCAST_PLACES else wanted
    same = F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("text_key") == F.col("f_text_key")) & (F.col("no") == F.col("f_no"))
    # Repeated rows give a place twice.
    return each.join(wanted, same).groupBy("part_id").agg(F.first("part").alias("part"))


def keepers(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """(part_id, keeper) for parts that occur more than once or near another: `keeper` is the first place of the group.

    `roots` (part_id, root) are the components of links between different parts.
    """
    named = distinct.join(roots, "part_id", "left").withColumn("root", F.coalesce("root", "part_id"))
    groups = named.groupBy("root").agg(F.min("first").alias("keeper"), F.sum("times").alias("occurrences"))
    return named.select("part_id", "root").join(groups.filter("occurrences > 1"), "root").select("part_id", "keeper")


def is_keeper(place: str = "keeper") -> Column:
    return (F.col("doc_id").eqNullSafe(F.col(f"{place}.doc_id")) & (F.col("text_key") == F.col(f"{place}.text_key"))
            & (F.col("no") == F.col(f"{place}.no")))


def without(docs: DataFrame, doomed: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`row` (all columns of a document), `n_parts`, `n_removed` and `left`, the text without the parts at `doomed`
    (the place columns); a document without such parts has its text as it was. A null text has no parts."""
    gone = doomed.groupBy(F.col("doc_id").alias("g_id"), F.col("text_key").alias("g_key")).agg(F.collect_set("no").alias("gone"))
    gone, seen = measured(gone, "gone", F.sum(F.size("gone") + 10).alias("cells"))
    gone = F.broadcast(gone) if (seen["cells"] or 0) <= BROADCAST_CELLS else gone
    rows = docs.select(whole(docs), F.col(doc_id).alias("own_id"), text_key(text).alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("g_id")) & (F.col("own_key") == F.col("g_key"))
    old = F.col(f"row.`{text}`")
    parts = F.split(old, "\n", -1)
    kept = F.array_join(F.filter(parts, lambda p, i: ~F.array_contains(F.col("gone"), i)), "\n")
    return rows.join(gone, same, "left").select(
        "row", F.when(old.isNull(), 0).otherwise(F.size(parts)).alias("n_parts"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
        F.when(F.col("gone").isNull(), old).otherwise(kept).alias("left"))
