"""Benchmark decontamination: a broadcast hash set of normalised test n-grams scanned over all training windows.

Native: DataFrame functions only. One pass over the documents hashes every window of `n` words, probes the hash set
and verifies each hit word for word; only hits are shuffled.

Defined results: null or wordless text has no words and no hits; a null or wordless item has no window; an item of
fewer than `n` words is one window; repeated items count once per item_id, repeated rows are reported once per row;
null document ids are kept as they are, items
without an id are left out. Other columns are ignored by the analysis and pass through `decontaminate`. Empty tables
give empty results, an empty benchmark no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import lower_ascii, text_key, whole
from vitrine.session import measured

#: The words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text lowered at A-Z, taken before lowering.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows up to this many bytes are broadcast; a larger benchmark is joined by a shuffle on the window hash.
BROADCAST_BYTES = 64 << 20


def words(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))


def _hashes(words_: Column) -> Column:
    """A hash per word that never tells apart what lowering A-Z makes equal."""
    return F.transform(words_, lambda w: F.xxhash64(F.lower(w)))


def _grams(hashes: Column, n: int) -> Column:
    """The hash of every run of `n` words, in order."""
    count = F.size(hashes)  # a second use of `hashes`, so that Catalyst does not move its computation into the lambda
    runs = F.transform(F.sequence(F.lit(1), F.greatest(count - (n - 1), F.lit(1))),
                       lambda i: F.xxhash64(F.slice(hashes, i, n)))
    return F.when(count >= n, runs).otherwise(F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", n: int = 10) -> DataFrame:
    """(gram, size, phrase, items): each distinct window with the ids of the items that hold it."""
    base = benchmark.select(F.col(item_id).cast("string").alias("item"), words(text).alias("words"))
    sized = base.dropna(subset=["item"]).withColumn("count", F.size("words")).filter("count > 0").withColumn("size", F.least("count", F.lit(n)))
    each = sized.select("item", "size", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("count") - F.col("size") + 1),
        lambda i: F.slice("words", i, F.col("size")))).alias("window"))
    return (each.select("item", "size", F.xxhash64(_hashes(F.col("window"))).alias("gram"),
                        lower_ascii(F.array_join("window", " ")).alias("phrase"))
            .groupBy("gram", "size", "phrase").agg(F.collect_set("item").alias("items")))


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 10) -> DataFrame:
    """One row per document and text: id, text_key, copies (rows with it), n_words, spans, items.

    `spans` are the verified windows as sorted structs (start, stop), zero-based word positions, stop exclusive.
    """
    found, seen = measured(windows(benchmark, n=n), "windows", F.count("*").alias("rows"),
                           F.sum(F.octet_length("phrase") + 64 + 40 * F.size("items")).alias("bytes"),
                           F.collect_set("size").alias("sizes"))
    sizes = sorted(seen["sizes"] or [], reverse=True)
    # One more entry than windows: the first element of each document's array stands for the document itself.
    head = found.sparkSession.createDataFrame([(0, 0, "", [])], found.schema)
    table = found.unionByName(head).withColumnsRenamed({"gram": "w_gram", "size": "w_size", "phrase": "w_phrase"})
    small = (seen["bytes"] or 0) <= BROADCAST_BYTES
    table = F.broadcast(table) if small else table.hint("merge")
    base = docs.select(F.col(doc_id).alias("id"), text_key(text).alias("text_key"), words(text).alias("words"))
    hashed = base.select("*", F.size("words").alias("n_words"), _hashes(F.col("words")).alias("hashes"))
    grams = hashed.select("id", "text_key", "words", "n_words", F.concat(
        F.array(F.lit(0).cast("bigint")), *(_grams(F.col("hashes"), s) for s in sizes)).alias("grams"))
    # The array is never empty; the outer form only keeps Catalyst from computing it all again in an inferred filter.
    each = grams.select("id", "text_key", "words", "n_words", F.posexplode_outer("grams").alias("at", "gram"))
    # Position `at` lies in the run of windows of one size; the runs follow one another.
    start, begin, size = F.col("at") - 1, F.lit(1), F.lit(0)
    for s in sizes:
        inside = F.col("at") >= begin
        start, size = F.when(inside, F.col("at") - begin).otherwise(start), F.when(inside, F.lit(s)).otherwise(size)
        begin = begin + F.greatest(F.col("n_words") - (s - 1), F.lit(0))
    said = lower_ascii(F.array_join(F.slice("words", F.greatest(start + 1, F.lit(1)), size), " "))
    if not small:  # what is shuffled carries its own window, not all words of the document
        each, said = each.withColumn("said", said).drop("words"), F.col("said")
    real = (F.col("at") > 0) & (F.col("w_size") == size) & (said == F.col("w_phrase"))
    met = each.join(table, (F.col("gram") == F.col("w_gram")) & F.when(F.col("at") == 0, F.col("w_size") == 0).otherwise(real))
    span = F.when(F.col("at") > 0, F.struct(start.alias("start"), (start + F.col("w_size")).alias("stop")))
    return met.groupBy("id", "text_key").agg(
        F.count(F.when(F.col("at") == 0, 1)).alias("copies"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(spans: str = "spans") -> Column:
    """How many words lie in at least one of the sorted spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(spans, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["stop"] - F.greatest(s["start"], acc["reach"]), F.lit(0))).alias("n"),
        F.greatest(acc["reach"], s["stop"]).alias("reach")), lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = hits(docs, benchmark, n=n).withColumn("n_hit", covered().cast("long"))
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), "n_hit",
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _without(text: str, spans: str) -> Column:
    """The text without the hit words and what follows each of them up to the next word; the rest as it was."""
    gaps = F.split(F.col(text), WORD, -1)
    pieces = F.arrays_zip(words(text).alias("word"), F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gap"))
    hit = lambda i: F.exists(spans, lambda s: (s["start"] <= i) & (i < s["stop"]))
    kept = F.transform(pieces, lambda p, i: F.when(~hit(i), F.concat(p["word"], p["gap"])).otherwise(F.lit("")))
    return F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, ""))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 10,
                  remove: str = "documents") -> DataFrame:
    """The documents without those that hold a window of the benchmark, or with `remove="spans"` without the words that
    windows cover. Columns and other rows are untouched."""
    dirty = hits(docs, benchmark, doc_id, text, n).filter(F.size("spans") > 0).select("id", "text_key", "spans")
    rows = docs.select(whole(docs), F.col(doc_id).alias("own_id"), text_key(text).alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("text_key"))
    if remove == "documents":
        return rows.join(dirty, same, "left_anti").select("row.*")
    old = F.col(f"row.`{text}`")
    cleaned = F.when(F.col("spans").isNull(), old).otherwise(_without(f"row.`{text}`", "spans"))
    return rows.join(dirty, same, "left").select(*((cleaned if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
