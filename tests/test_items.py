from datetime import datetime

from vitrine.operators import dedup, items
from pyspark.sql import functions as F

from conftest import rows

NOW = datetime(2024, 1, 20, 12, 0, 0)
SCHEMA = ("pos int, product_id string, name string, price string, category string, rating string, source string, "
          "scraped_at string")


def test_cleaning(spark):
    df = spark.createDataFrame([
        (1, "123", "produto teste", "R$ 99,90", "eletronicos", "Three", "https://example.com/products?page=1",
         "2024-01-15T10:00:00"),
        (2, "124", " outro ", "abc", "mesa posta", "x", "https://example.com/a/", None)], SCHEMA)
    assert [tuple(r) for r in items.clean_items(df, NOW).orderBy("pos").collect()] == [
        (1, "123", "Produto Teste", 99.9, "Eletronicos", 3, "https://example.com/products", "2024-01-15T10:00:00"),
        (2, "124", "Outro", None, "Mesa Posta", None, "https://example.com/a", "2024-01-20T12:00:00")]


def test_numeric_prices_are_rounded_and_keep_their_sign(spark):
    df = spark.createDataFrame([(1, 1234.567), (2, -10.0), (3, None)], "pos int, price double")
    assert rows(items.clean_items(df, NOW)) == [(1, 1234.57), (2, -10.0), (3, None)]


def test_validation(spark):
    df = spark.createDataFrame([
        (1, "123", "produto teste", "99.90"), (2, None, "", None), (3, "123", None, "99.90"), (4, "123", "Teste", "0"),
        (5, "123", "Teste", "-10"), (6, "123", "Teste", "invalido")], "pos int, product_id string, name string, price string")
    assert [r.pos for r in items.valid_items(df).collect()] == [1]
    assert dict(rows(items.rejected_items(df), "pos", "reject_reason")) == {
        2: "missing: product_id, name, price", 3: "missing: name", 4: "price is not positive",
        5: "price is not positive", 6: "price is not a number"}
    numeric = spark.createDataFrame([(1, "1", "a", 0.0), (2, "1", "a", -1.0), (3, "1", "a", 2.0)],
                                    "pos int, product_id string, name string, price double")
    assert [r.pos for r in items.valid_items(numeric).collect()] == [3]


def test_first_item_wins_and_items_without_id_stay(spark):
    df = spark.createDataFrame([
        (1, "1", "a", "first"), (2, "1", "a", "second"), (3, "2", "a", "x"), (4, "1", "b", "y"),
        (5, None, "a", "n"), (6, None, "a", "n"), (7, "", "a", "n")],
        "pos int, product_id string, source string, name string")
    assert [r[0] for r in rows(dedup.first_per_item(df, ["pos"]))] == [1, 3, 4, 5, 6, 7]
    # Id-less rows stay even where nothing tells them apart.
    same = spark.createDataFrame([(None, "a")] * 3, "product_id string, source string")
    assert dedup.first_per_item(same, ["source"]).count() == 3


def test_chain(spark):
    df = spark.createDataFrame([
        (1, "1", "um", "R$ 10,00", None, None, "https://s/?p=1", None),
        (2, "1", "um", "R$ 11,00", None, None, "https://s/?p=2", None),
        (3, "2", "dois", "gratis", None, None, "https://s/", None)], SCHEMA)
    assert rows(items.item_chain(df, NOW, ["pos"]), "pos", "price") == [(1, 10.0)]
    assert rows(items.item_chain(df, NOW, ["pos"], validate=False), "pos", "price") == [(1, 10.0), (3, None)]


def test_newest_per_key(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("a", None, 3), ("b", None, 4),
                                (None, "2024-01-01", 5), (None, "2024-01-02", 6)],
                               "k string, scraped_at string, v int").withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    assert rows(dedup.newest_per_key(df, ["k"]), "k", "v") == [("a", 2), ("b", 4), (None, 6)]


def test_one_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                  F.timestamp_seconds("id").alias("scraped_at"), "id")
    plan = dedup.newest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_first_rows_match_a_plain_ranking(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                  F.col("id"))
    found = dedup.first_rows(df, ["g"], ["id"], 40, spread=8)
    by_group = {}
    for r in df.orderBy("id").collect():
        by_group.setdefault(r.g, []).append(r.id)
    assert rows(found, "g", "id") == sorted(((g, i) for g, ids in by_group.items() for i in ids[:40]), key=repr)
