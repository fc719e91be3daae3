"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import (decontaminate, embedding_dedup, fingerprints, html_text, line_dedup, mixing, paragraph_dedup, quality, secret_scan,
                         simhash, spelling, token_alignment, warc)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_benchmark_decontamination(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_source_mixing(spark, sf_dir):
    taken = mixing.plan(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents"))


@query
def op3_paragraph_dedup(spark, sf_dir):
    return paragraph_dedup.removals(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    found = line_dedup.dedup(table(spark, sf_dir, "documents"), bits=None)
    return found.select("row.doc_id", F.col("n_parts").alias("n_lines"), "n_removed", F.col("left").alias("text"))


@query
def op1_warc_transactions(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", quality.grade().alias("grade"))
    return quality.rate(docs, quality.train(docs, labels)).select("row.doc_id", "expected_grade", "tail_probability", "accepted")


@query
def op7_html_main_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op10_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op5_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.groups(table(spark, sf_dir, "embeddings"))


@query
def op11_tokenizer_alignment(spark, sf_dir):
    return token_alignment.digests(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_document_fingerprints(spark, sf_dir):
    return fingerprints.edited(table(spark, sf_dir, "documents"))
