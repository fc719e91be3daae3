import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import quality, quantiles as qt
from vitrine.plans import marts, reports, sales, staging

from conftest import rows


def sample(spark, seed=7):
    rng = random.Random(seed)
    found = [("hot", rng.choice([1.0, 2.5, round(rng.lognormvariate(5, 3), 2)])) for _ in range(4000)]
    found += [("neg", rng.uniform(-1e6, 1e6)) for _ in range(501)] + [("one", 3.25)] + [("same", 7.0)] * 50
    found += [(None, float(i)) for i in range(10)] + [("none", None)]
    return spark.createDataFrame(found, "g string, v double"), found


def test_quantiles_match_brute_force(spark):
    df, found = sample(spark)
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    result = {r.g: r for r in qt.quantiles(df, "g", "v", probs).collect()}
    assert set(result) == {"hot", "neg", "one", "same", None}
    for g, row in result.items():
        values = [v for k, v in found if k == g and v is not None]
        assert row.n == len(values)
        assert [row[f"q{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-9)


def test_box_and_histogram(spark):
    df, found = sample(spark)
    values = np.array([v for k, v in found if k == "hot"])
    q1, q3 = np.quantile(values, [0.25, 0.75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    row = qt.box_stats(df, "g", "v").filter("g = 'hot'").first()
    assert (row.lower_whisker, row.upper_whisker) == (inside.min(), inside.max())
    one = df.filter("g = 'neg'")
    counts = np.histogram([v for k, v in found if k == "neg"], bins=30)[0]
    bins = {r.bin: r.n for r in qt.histogram(one, "v").collect()}
    assert [bins.get(i, 0) for i in range(30)] == list(counts)
    assert rows(qt.histogram(df.filter("g = 'same'"), "v"), "bin", "n") == [(0, 50)]


def test_dashboard_filters_and_rules(spark):
    raw = {"books": spark.createDataFrame([("1", "b", 10.0, None, "Ficcao"), ("2", "c", None, None, None)],
                                          "product_id string, name string, price double, scraped_at timestamp, category string"),
           "amazon": spark.createDataFrame([("3", "d", 20.0, None)], "product_id string, name string, price double, scraped_at timestamp"),
           "americanas": spark.createDataFrame([("4", "e", 30.0, None)], "product_id string, name string, price double, scraped_at timestamp")}
    found = reports.all_listings(raw)
    assert rows(found, "source", "category") == [("Amazon", "Amazon"), ("Americanas", "Geral"), ("Books", "Ficcao"), ("Books", None)]
    assert reports.filtered(found).count() == 3
    assert rows(reports.filtered(found, ["Books", "Amazon"], 15), "product_id") == [("3",)]
    assert rows(reports.price_bounds(found)) == [(0.0, 30.0)]
    assert rows(reports.price_bounds(found.limit(0))) == [(0.0, 1000.0)]
    assert rows(reports.largest_categories(found)) == [("Amazon", 1), ("Ficcao", 1), ("Geral", 1)]
    matrix = {r.category: r.asDict() for r in reports.category_matrix(found).collect()}
    assert matrix["Ficcao"] == {"category": "Ficcao", "Books": 10.0, "Amazon": 0.0, "Americanas": 0.0, "KaBuM": 0.0}
    assert reports.price_sample(found, 2, 1).count() == 2 and reports.price_sample(found, 500, 1).count() == 4
    assert rows(reports.currency_table(found).filter("product_id = '3'"), "price") == [("R$ 20,00",)]
    assert rows(reports.cdc_columns(("books",), spark)) == [("raw.books", "updated_at, deleted_at, _extract_ts")]


def test_staging_rules(spark):
    books = spark.createDataFrame([("1", "x", "Three"), ("2", "7.5", "4.5"), ("3", "1", None), ("4", "NaN", "zero")],
                                  "product_id string, price string, rating string")
    assert rows(staging.stg_books(books), "product_id", "price", "rating", "rating_label") == [
        ("1", None, 3.0, "Bom"), ("2", 7.5, 4.5, "Excelente"), ("3", 1.0, None, "Sem avaliacao"), ("4", None, None, "Sem avaliacao")]
    kabum = spark.createDataFrame([("1", "9", "8", "3.7", None, "x", "other")], "product_id string, price string, old_price string, "
                                  "stock string, reviews_count string, rating string, source string")
    assert rows(staging.stg_shop(kabum, "kabum")) == [("1", 9.0, 8.0, 3, 0, None, "kabum")]


def test_books_without_category_have_no_average(spark):
    books = spark.createDataFrame([("1", "a", 10.0, 4.0, "Bom", "A"), ("2", "b", 30.0, 4.0, "Bom", "A"), ("3", "c", 5.0, 4.0, "Bom", None)],
                                  "product_id string, name string, price double, rating double, rating_label string, category string")
    books = books.withColumns({"source": F.lit("s"), "scraped_at": F.lit(None).cast("timestamp")})
    assert rows(marts.dim_books(books), "book_id", "price_vs_category") == [("book_1", -50.0), ("book_2", 50.0), ("book_3", 0.0)]


def test_order_branch_with_customers_and_products_without_orders(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "customer_id bigint, first_name string")
    orders = spark.createDataFrame([(10, 1, "2024-01-01"), (11, 2, "2024-01-02")], "order_id bigint, customer_id bigint, order_date string")
    items = spark.createDataFrame([(10, 5, 2, 3.0)] * 6 + [(11, 5, 1, 4.0), (11, 6, 1, 1.5), (99, 6, 1, 1.0)],
                                  "order_id bigint, product_id bigint, quantity int, unit_price double")
    products = spark.createDataFrame([(5, "p"), (6, "q"), (7, "r")], "product_id bigint, name string")
    facts = sales.fact_orders(sales.int_order_items(sales.stg_orders(orders), items))
    assert facts.count() == 8
    assert rows(sales.dim_customers(sales.stg_customers(customers), facts), "customer_id", "total_orders", "total_spent", "customer_segment") == [
        (1, 6, 36.0, "VIP"), (2, 2, 5.5, "Recorrente"), (3, 0, 0.0, "Novo")]
    assert rows(sales.dim_product_sales(sales.stg_products(products), items), "product_id", "times_sold", "total_quantity_sold", "total_revenue") == [
        (5, 7, 13, 40.0), (6, 2, 2, 2.5), (7, 0, 0, 0.0)]


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.orphans(child, "k", parent, "id")) == sorted([(1, 2), (None, 2)], key=repr)


def test_checks_share_one_scan_per_table(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), (None, -1.0, "y"), ("b", None, None)], "k string, p double, s string")
    c = quality.Check
    checks = [c("load", "not_null", "t", "k"), c("load", "positive", "t", "p"), c("load", "in_set", "t", "s", values=("x",)),
              c("load", "rows", "t", min_rows=4), c("cdc", "cdc", "t"), c("load", "not_null", "gone", "k")]
    result = quality.run_checks(spark, checks, {"t": df}.get)
    assert {(r.test, r.status, r.message) for r in result.collect()} == {
        ("load_notnull_t_k", "FAIL", "t.k: 1 nulos"), ("positive_t_p", "FAIL", "t.p: 1 negativos"),
        ("value_in_set_t_s", "FAIL", "t.s: 2 invalidos"), ("load_rowcount_t", "FAIL", "t tem 3 registros (minimo: 4)"),
        ("cdc_t", "FAIL", "t: colunas faltando ['updated_at', '_extract_ts', 'deleted_at']"),
        ("load_notnull_gone_k", "FAIL", "gone nao existe")}
    assert quality.by_stage(result, "cdc").count() == 1 and quality.failed(result).count() == 6
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("count_if") + plan.count("Aggregate") < 12


def test_key_checks_share_the_scan(spark):
    """Several keys and row checks of a table: one scan, one exchange of groups; NULLs as each kind has them."""
    schema = "a int, b string, p double"
    df = spark.createDataFrame([(1, "x", -1.0), (1, "x", 2.0), (None, "y", 3.0), (None, "y", 4.0), (2, None, 5.0)], schema)
    c = quality.Check
    checks = [c("load", "key", "t", columns=("a", "b")), c("load", "unique", "t", "a"), c("load", "duplicates", "t", "a"),
              c("load", "unique", "t", "b", test="b"), c("load", "key", "t", columns=("b", "a"), test="again"),
              c("load", "not_null", "t", "a"), c("load", "positive", "t", "p"), c("load", "rows", "t")]

    def counts(frame):
        return {r.test: int("".join(ch for ch in r.message.split("(")[0] if ch.isdigit())) for r in quality.run_checks(spark, checks, {"t": frame}.get).collect()}
    assert counts(df) == {"key_t": 1, "load_unique_t_a": 4, "transform_dedup_t_a": 2, "b": 4, "again": 1, "load_notnull_t_a": 2,
                          "positive_t_p": 1, "load_rowcount_t": 5}
    assert set(counts(spark.createDataFrame([], schema)).values()) == {0}
    for column in ("a", "b"):
        assert counts(df)["load_unique_t_a" if column == "a" else "b"] == quality.duplicate_keys(df, column).first().n_rows
    plan = quality.run_checks(spark, checks, {"t": df}.get)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_definition_checks(spark):
    orders = spark.createDataFrame([(1, 1, "x" * 51), (1, 9, "ok"), (None, None, None), (None, 1, None)],
                                   "order_id bigint, customer_id bigint, status string")
    customers = spark.createDataFrame([(1,)], "customer_id bigint")
    result = quality.run_checks(spark, quality.definition_checks("raw.orders"), {"raw.orders": orders, "raw.customers": customers}.get)
    assert rows(result, "test", "status", "message") == [
        ("key_orders", "FAIL", "raw.orders: 1 chaves repetidas"),
        ("length_orders_status", "FAIL", "raw.orders.status: 1 textos longos demais"),
        ("load_fk_orders_customer_id", "FAIL", "raw.orders.customer_id: 2 chaves invalidas")]


def test_a_hot_order_is_split(spark):
    """One order with nearly all items: AQE cuts its partition into several tasks."""
    orders = spark.range(200).select(F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit("2024-01-01").alias("order_date"))
    items = spark.range(60000).select(F.when(F.col("id") % 20 > 0, 7).otherwise(F.col("id") % 200).alias("order_id"),
                                      F.col("id").alias("product_id"), F.lit(2).alias("quantity"), F.rand(1).alias("unit_price"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = sales.int_order_items(sales.stg_orders(orders), items)
        assert joined.filter("order_id = 7").count() > 50000
        assert len(joined.collect()) == 60000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "skew=true" in plan
