import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vitrine.operators import health, lineage, quality, upsert
from vitrine.operators.upsert import add_cdc_columns, change_rows, insert_only
from vitrine.plans import daily, publish, raw_load, reports, transform
from vitrine.sources import files
from vitrine.schemas import SHOPS
from vitrine.streaming import drops

from conftest import rows

RUN = datetime(2024, 2, 1, 6, 0, 0)
TARGET = "k string, s string, a int, b string"


def test_upsert_cases(spark):
    target = spark.createDataFrame([("1", "x", 1, "keep"), ("2", "x", 2, "keep"), (None, "x", 9, "null key")], TARGET)
    batch = spark.createDataFrame([("1", "x", 10), ("3", "x", 30), (None, "x", 90), ("2", "x", None)], "k string, s string, a int")
    assert rows(upsert.upsert(target, batch, ["k", "s"])) == sorted([
        ("1", "x", 10, "keep"), ("2", "x", None, "keep"), ("3", "x", 30, None), (None, "x", 9, "null key"),
        (None, "x", 90, None)], key=repr)
    assert rows(insert_only(target, batch, ["k", "s"])) == sorted([("3", "x", 30), (None, "x", 90)], key=repr)
    changed = change_rows(target, batch.filter("k is not null"), ["k", "s"], "raw.t", RUN)
    assert rows(changed, "source_key", "operation") == [("1|x", "update"), ("2|x", "update"), ("3|x", "insert")]
    with pytest.raises(ValueError):
        upsert.upsert(target, batch.withColumn("zz", F.lit(1)), ["k", "s"])


def test_cdc_columns_are_only_added_when_missing(spark):
    df = spark.createDataFrame([(1, RUN - timedelta(days=1))], "a int, updated_at timestamp")
    row = add_cdc_columns(df, RUN).first()
    assert (row.updated_at, row._extract_ts, row.deleted_at) == (RUN - timedelta(days=1), RUN, None)


def cell_files(house, table):
    """Files of the newest version, by name."""
    return set(house.spark.table(f"{house.name(table)}__v{house._versions(table)[-1]}").inputFiles())


def books(spark, ids, price=1.0):
    return spark.createDataFrame([(None if i is None else f"{i:05d}", "s", f"Book {i}", float(price)) for i in ids],
                                 "product_id string, source string, name string, price double")


def test_small_batch_leaves_other_files_as_they_are(spark, house):
    house.cells = 20
    spark.sql(f"create schema if not exists {house.prefix}lineage")
    raw_load.upsert_table(house, "raw.books", books(spark, range(2000)), RUN)
    before = cell_files(house, "raw.books")
    # One in a hundred keys, old ones side by side and new ones after the last.
    batch = books(spark, [*range(700, 710), *range(3000, 3010)], 2)
    rows_read, cells = house.touched("raw.books", batch, ["product_id", "source"])
    assert len(cells) <= 2 and rows_read.count() < 400
    house.cells = None
    raw_load.upsert_table(house, "raw.books", batch, RUN + timedelta(days=1))
    after = cell_files(house, "raw.books")
    assert len(before) >= 15 and len(before & after) == len(before) - len(cells)
    found = house.read("raw.books")
    assert found.columns == [*batch.columns, "updated_at", "_extract_ts", "deleted_at"]
    assert rows(found.groupBy("price").count()) == [(1.0, 1990), (2.0, 20)]
    assert rows(house.read("lineage.change_tracking").groupBy("operation").count()) == [("insert", 2010), ("update", 10)]
    # New keys alone, and conflicts to be ignored, add files and rewrite none.
    raw_load.upsert_table(house, "raw.books", books(spark, [0, 4000], 3), RUN + timedelta(days=2), ignore_conflicts=True)
    assert after < cell_files(house, "raw.books") and found.count() == 2010
    assert rows(house.read("raw.books").filter("product_id in ('00000', '04000')"), "product_id", "price") == [("00000", 1.0), ("04000", 3.0)]
    # The plan over the touched cells lists no other cell.
    _, cells = house.touched("raw.books", books(spark, [705]), ["product_id", "source"])
    assert len(cells) == 1 and len(house.touched("raw.books", books(spark, [705]), ["product_id", "source"])[0].inputFiles()) == 1
    house.truncate("raw.books")
    assert house.count("raw.books") == 0 and house.touched("raw.books", books(spark, [1]), ["product_id", "source"])[1] == []


def test_forgotten_cells_are_deleted_and_old_readers_live(spark, house):
    raw_load.upsert_table(house, "raw.books", books(spark, range(50)), RUN, track_changes=False)
    first, reader = cell_files(house, "raw.books"), house.read("raw.books")
    raw_load.upsert_table(house, "raw.books", books(spark, range(50), 2), RUN, track_changes=False)
    assert rows(reader.groupBy("price").count()) == [(1.0, 50)]  # planned before the switch
    raw_load.upsert_table(house, "raw.books", books(spark, range(50), 3), RUN, track_changes=False)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in first)
    assert rows(house.read("raw.books").groupBy("price").count()) == [(3.0, 50)]


def test_rows_without_a_key_are_added_once(spark, house):
    for day in range(3):
        raw_load.upsert_table(house, "raw.books", books(spark, [1, None, None]), RUN + timedelta(days=day), track_changes=False)
    assert rows(house.read("raw.books"), "product_id", "name") == [("00001", "Book 1"), (None, "Book None"), (None, "Book None")]
    raw_load.upsert_table(house, "raw.books", books(spark, [None], 5), RUN, track_changes=False)
    assert house.count("raw.books") == 4


def test_repeated_batch_adds_no_lineage_and_reads_no_old_partition(spark, house):
    house.create_all()
    for day in range(3):
        raw_load.upsert_table(house, "raw.books", books(spark, range(5), day), RUN + timedelta(days=day))
    kept = rows(house.read("lineage.change_tracking"))
    raw_load.upsert_table(house, "raw.books", books(spark, range(5), 1), RUN + timedelta(days=1))
    raw_load.upsert_table(house, "raw.books", books(spark, range(5), 1), RUN + timedelta(days=1))
    assert rows(house.read("lineage.change_tracking")) == kept and len(kept) == 15
    raw_load.upsert_table(house, "raw.books", books(spark, range(5), 7), RUN + timedelta(days=1))  # another batch of that run
    assert house.count("lineage.change_tracking") == 20
    table = spark.table(house.name("lineage.change_tracking"))
    mine = table.filter((F.col("_run") == str(RUN)) & (F.col("_batch") == "raw.books"))
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_run" in plan and len(spark.sql(f"show partitions {house.name('lineage.change_tracking')}").collect()) == 3


def test_tables_versions_and_truncate(spark, house):
    house.create_all()
    assert house.exists("raw.books") and not house.exists("raw.nothing")
    for i in range(3):
        house.replace("raw.books", house.read("raw.books").unionByName(
            spark.createDataFrame([(str(i), "n")], "product_id string, name string"), allowMissingColumns=True))
    assert house.count("raw.books") == 3
    assert len(house._versions("raw.books")) == 2
    house.replace("raw.customers", spark.createDataFrame([(1,)], "customer_id bigint"))
    house.replace("raw.orders", spark.createDataFrame([(1, 1)], "order_id bigint, customer_id bigint"))
    house.replace("raw.order_items", spark.createDataFrame([(1, 1, 1)], "order_item_id bigint, order_id bigint, product_id bigint"))
    house.truncate("raw.customers")
    assert [house.count(f"raw.{t}") for t in ("customers", "orders", "order_items", "books")] == [0, 0, 0, 3]


def write_drop(folder, shop, name, records):
    path = folder / shop
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(records if isinstance(records, str) else json.dumps(records, indent=2))


def item(pid, price, at, **more):
    return {"product_id": pid, "name": f"Item {pid}", "price": price, "source": "s", "scraped_at": at, **more}


def test_load_directory(spark, house, tmp_path):
    data = tmp_path / "raw"
    write_drop(data, "books", "b1.json", [item("1", 10.5, "2024-01-02T00:00:00"), item("1", 9, "2024-01-01T00:00:00"),
                                          item("2", "7.25", "2024-01-01T00:00:00+00:00", rating=4)])
    write_drop(data, "books", "b2.json", [item("1", 8, "2023-12-31T00:00:00")])
    write_drop(data, "books", "bad.json", "not json")
    write_drop(data, "books", "empty.json", [])
    write_drop(data, "books", "half.json", "\n".join([json.dumps(item("8", 3, "2023-01-01T00:00:00")), "{bad", json.dumps(item("9", 4, "2023-01-01T00:00:00"))]))
    write_drop(data, "kabum", "k.parquet", "no parquet")
    spark.createDataFrame([("5", "Amazon item", 3.5)], "product_id string, name string, price double").coalesce(1).write.parquet(
        str(data / "amazon" / "a.parquet"))
    write_drop(data, "amazon", "broken.parquet", "no parquet")
    results = raw_load.load_directory(house, str(data), RUN)
    found = {(r.shop, r.file.split("/")[-1].split("-")[0]): (r.status, r["count"]) for r in results.collect()}
    assert found == {("books", "b1.json"): ("success", 2), ("books", "b2.json"): ("success", 1),
                     ("books", "bad.json"): ("error", 0), ("books", "empty.json"): ("success", 0),
                     ("books", "half.json"): ("partial", 2), ("kabum", "k.parquet"): ("error", 0),
                     ("amazon", "part"): ("success", 1), ("amazon", "broken.parquet"): ("error", 0)}
    books = house.read("raw.books")
    assert rows(books.select("product_id", F.col("price").cast("double"), "rating", "_extract_ts")) == [
        ("1", 10.5, None, RUN), ("2", 7.25, 4, RUN), ("8", 3.0, None, RUN), ("9", 4.0, None, RUN)]
    assert rows(house.read("lineage.change_tracking"), "source_table", "operation") == [
        ("raw.amazon", "insert"), *[("raw.books", "insert")] * 4]
    assert rows(house.read("lineage.data_lineage").groupBy("target_table", "status").count()) == [
        ("amazon", "error", 1), ("amazon", "success", 1), ("books", "error", 1), ("books", "partial", 1), ("books", "success", 2),
        ("kabum", "error", 1)]

    # A second run updates, keeps what is absent and leaves one row per key.
    write_drop(data, "books", "b1.json", [item("1", 20, "2024-01-05T00:00:00")])
    raw_load.load_directory(house, str(data), RUN + timedelta(days=1))
    assert rows(house.read("raw.books").select("product_id", F.col("price").cast("double"))) == [
        ("1", 20.0), ("2", 7.25), ("8", 3.0), ("9", 4.0)]


def test_parquet_drops_of_different_layouts(spark, tmp_path):
    make = lambda name, rows_, schema: spark.createDataFrame(rows_, schema).coalesce(1).write.parquet(str(tmp_path / "amazon" / name))
    make("a.parquet", [("1", 1.5)], "product_id string, price double")
    make("b.parquet", [("2", "2.5", 4.5)], "product_id string, price string, rating double")
    write_drop(tmp_path, "amazon", "c.parquet", "no parquet")
    found = files.read_shop_drops(spark, str(tmp_path), "amazon")
    assert rows(found.select("product_id", "price", "rating"))[:2] == [("1", "1.5", None), ("2", "2.5", "4.5")]
    assert found.filter(f"{files.CORRUPT} is not null").count() == 1


def test_load_files(spark, house, tmp_path):
    house.create_all()
    write_drop(tmp_path, "books", "b.json", [item("1", 1, None), item("1", 2, "2024-01-01")])
    write_drop(tmp_path, "books", "none.json", [])
    write_drop(tmp_path, "books", "bad.json", "{")
    assert raw_load.load_files(house, "books", [str(tmp_path / "books/b.json")], RUN) == 1
    assert raw_load.load_files(house, "books", [str(tmp_path / "books/none.json")], RUN) == 0
    with pytest.raises(ValueError):
        raw_load.load_files(house, "books", [str(tmp_path / "books/bad.json")], RUN)
    spark.createDataFrame([], "product_id string, name string").write.parquet(str(tmp_path / "e.parquet"))
    with pytest.raises(raw_load.EmptyBatch):
        raw_load.load_files(house, "books", [str(tmp_path / "e.parquet")], RUN, kind="parquet")
    assert house.count("lineage.data_lineage") == 1


def test_insert_only_and_default_key(spark, house):
    first = spark.createDataFrame([("1", "a"), ("2", "b")], "product_id string, name string")
    assert raw_load.upsert_table(house, "staging.stg_x", first, RUN) == 2
    second = spark.createDataFrame([("1", "z"), ("3", "c")], "product_id string, name string")
    raw_load.upsert_table(house, "staging.stg_x", second, RUN, ignore_conflicts=True)
    assert rows(house.read("staging.stg_x"), "product_id", "name") == [("1", "a"), ("2", "b"), ("3", "c")]
    assert raw_load.upsert_table(house, "staging.stg_x", first.limit(0), RUN) == 0


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"n{i}", float(i)) for i in range(10)], "product_id string, name string, price double")
    written = files.export_items(df, str(tmp_path), "books", RUN)
    assert [w.split("/")[-1] for w in written] == ["books_20240201_060000.parquet", "books_20240201_060000.jsonl"]
    assert rows(spark.read.parquet(written[0])) == rows(df) == rows(spark.read.schema(df.schema).json(written[1]))
    assert files.export_items(df.limit(0), str(tmp_path), "kabum", RUN) == [] and not (tmp_path / "kabum").exists()
    assert len(files.export_items(df, str(tmp_path), "amazon", RUN, ("json",))) == 1


def drops_for_all(data, n=12, at="2024-02-01T05:00:00"):
    extra = {"books": {"rating": 4, "category": "Livros"}, "amazon": {"original_price": 60.0, "reviews_count": "7"},
             "americanas": {"list_price": 500.0, "category": None}, "kabum": {"old_price": 10.0, "stock": 3}}
    for shop in SHOPS:
        write_drop(data, shop, f"{shop}.json", [item(str(i), 50.0 + i, at, **extra[shop]) for i in range(n)])


def test_daily_run(spark, house, tmp_path):
    drops_for_all(tmp_path / "d")
    out = daily.daily_run(house, str(tmp_path / "d"), RUN, report_path=str(tmp_path / "health"))
    assert out["status"] == "healthy" and out["published"] == {"dim_books": 12, "dim_products": 36}
    assert out["transform"]["staging"] == {f"stg_{s}": 12 for s in SHOPS} and out["transform"]["warnings"] == []
    found = house.read("report.dim_products").filter("id = '0_americanas'").first()
    assert (found.price, found.original_price, found.discount_percentage, found.price_tier) == (50.0, 500.0, 90.0, "Economico")
    stages = house.read("lineage.stage_checks")
    assert rows(stages.groupBy("stage", "status").count()) == [("extract", "PASS", 8), ("load", "PASS", 6), ("transform", "PASS", 4)]
    daily.stage_checks(house, "load", RUN)  # a repeat of the run's stage adds nothing
    assert house.read("lineage.stage_checks").count() == 18
    with pytest.raises(ValueError):
        quality.stage_suite("publish")
    report = spark.read.json(str(tmp_path / "health")).first()
    assert (report.status, report.passed, report.total, len(report.checks), report.alerts) == ("healthy", 22, 22, 22, [])
    assert rows(quality.pass_count(house.read("report.quality_results"))) == [(29, 29, True)]
    assert rows(quality.pass_count(quality.run_checks(spark, quality.mart_suite(), daily.resolver(house)))) == [(12, 14, False)]

    csv, js = publish.all_to_csv(house, str(tmp_path / "csv")), publish.all_to_json(house, str(tmp_path / "json"))
    assert csv == js == {"dim_books": 12, "dim_products": 36}
    assert spark.read.option("header", True).csv(str(tmp_path / "csv/dim_products.csv")).count() == 36

    names = reports.dashboard(house, {s: house.read(f"raw.{s}") for s in SHOPS}, sources=["Books", "KaBuM"], low=55)
    assert spark.table(names["listings"]).count() == 14
    assert rows(spark.table(names["volume"])) == [("Books", 7, 0.5), ("KaBuM", 7, 0.5)]

    # Only rows extracted after the given time are read again.
    later = RUN + timedelta(days=1)
    write_drop(tmp_path / "d2", "kabum", "k.json", [item("0", 999.0, "2024-02-02T05:00:00")])
    raw_load.load_directory(house, str(tmp_path / "d2"), later)
    counts = transform.run_all(house, later, since=RUN)
    assert counts["staging"] == {"stg_books": 0, "stg_amazon": 0, "stg_americanas": 0, "stg_kabum": 1}
    assert counts["marts"]["dim_products"] == 1 and house.count("marts.dim_products") == 36
    assert house.read("marts.dim_products").filter("id = '0_kabum'").first().price == 999.0

    # A late row that is older than the staged one does not replace it.
    latest = RUN + timedelta(days=2)
    write_drop(tmp_path / "d3", "kabum", "k.json", [{**item("0", 1.0, "2024-01-01T05:00:00"), "source": "another page"}])
    raw_load.load_directory(house, str(tmp_path / "d3"), latest)
    transform.run_all(house, latest, since=later)
    assert house.read("staging.stg_kabum").filter("product_id = '0'").first().price == 999.0


def test_gates_stop_the_run(spark, house, tmp_path):
    drops_for_all(tmp_path / "d")
    write_drop(tmp_path / "d", "kabum", "nameless.json", [{"product_id": "n", "price": 1, "source": "s"}])
    with pytest.raises(daily.GateFailed, match="stg_kabum.name: 1 nulos"):
        daily.daily_run(house, str(tmp_path / "d"), RUN)
    spark.sql(f"drop view {house.prefix}marts.dim_books")
    with pytest.raises(daily.GateFailed, match="unhealthy"):
        daily.health_gate(house, RUN + timedelta(days=30))


def test_sales_tables(spark, house):
    house.create_all()
    typed = lambda table, *found: spark.createDataFrame(found, "a bigint, b bigint, c bigint, d int, e double").selectExpr(*table)
    house.replace("raw.customers", spark.range(1, 4).selectExpr("id as customer_id", "'n' as first_name"))
    house.replace("raw.products", spark.range(5, 8).selectExpr("id as product_id", "'p' as name"))
    house.replace("raw.orders", spark.range(10, 12).selectExpr(
        "id as order_id", "id - 9 as customer_id", "date'2024-01-01' as order_date"))
    house.replace("raw.order_items", typed(
        ("a as order_item_id", "b as order_id", "c as product_id", "d as quantity", "cast(e as decimal(10,2)) as unit_price"),
        (1, 10, 5, 2, 3.1), (2, 10, 6, 1, 4.05), (3, 11, 5, 3, 3.1)))
    transform.run_sales(house)
    customers = house.read("marts.dim_customers").select("customer_id", F.col("total_spent").cast("double"), "customer_segment")
    assert rows(customers) == [(1, 10.25, "Recorrente"), (2, 9.3, "Novo"), (3, 0.0, "Novo")]
    assert rows(house.read("marts.dim_product_sales"), "product_id", "times_sold") == [(5, 2), (6, 1), (7, 0)]
    assert house.count("marts.fact_orders") == 3


def test_health_of_other_tables(spark):
    df = spark.createDataFrame([(1, RUN - timedelta(hours=30)), (1, None)], "k int, seen timestamp")
    found = {r.check: r.message for r in health.table_checks(spark, "staging.t", df, RUN, 24, 3, "seen").collect() if not r.passed}
    assert found == {"staging_t_freshness": "Dados de staging.t estao 30.0h atrasados (max: 24h)",
                     "staging_t_min_rows": "Tabela staging.t tem apenas 2 linhas (minimo: 3)"}
    twice = health.mart_checks(spark, "t", "k", df, "staging").filter("not passed").first()
    assert (twice.check, twice.message) == ("t_unique_id", "Tabela staging.t tem 1 duplicatas em k")
    assert [r.passed for r in health.table_checks(spark, "staging.gone", None, RUN).collect()] == [False] * 4


def test_health_details(spark):
    df = spark.createDataFrame([(RUN - timedelta(hours=72),)] * 3, "scraped_at timestamp")
    found = {r.check: (r.passed, r.message) for r in health.raw_checks(spark, "books", df, RUN).collect()}
    assert found["raw_books_freshness"] == (False, "Dados de raw.books estao 72.0h atrasados (max: 48h)")
    assert found["raw_books_min_rows"] == (False, "Tabela raw.books tem apenas 3 linhas (minimo: 10)")
    no_time = {r.check: (r.passed, r.message) for r in health.raw_checks(spark, "books", df.select(F.lit(None).cast("timestamp").alias("scraped_at")), RUN).collect()}
    assert no_time["raw_books_freshness"] == (False, "Tabela raw.books sem dados de scraped_at")
    no_column = {r.check: r.passed for r in health.raw_checks(spark, "books", spark.range(20).toDF("x"), RUN).collect()}
    assert no_column == {"raw_books_exists": True, "raw_books_not_empty": True, "raw_books_freshness": True, "raw_books_min_rows": True}
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    marts = health.mart_checks(spark, "dim_products", "id", twice)
    assert [r.passed for r in marts.collect()] == [True, True, False]
    gone = health.mart_checks(spark, "dim_books", "book_id", None)
    assert rows(health.alerts(gone, RUN)) == [("WARNING", "Tabela marts.dim_books nao existe", "2024-02-01T06:00:00")] * 3
    assert [health.summary(marts.unionByName(m)).first().status for m in (gone, marts.filter("passed"))] == ["unhealthy", "degraded"]


def test_lineage_row(spark, house):
    house.create_all()
    house.append("lineage.data_lineage", lineage.lineage_row(spark, "f.json", "file", "raw.books", "load", 5, RUN, 1.25,
                                                              "error", "boom", "abc", 7))
    row = house.read("lineage.data_lineage").first()
    assert (row.target_schema, row.target_table, row.record_count, float(row.duration_seconds), row.error_message,
            row.parent_lineage_id) == ("raw", "books", 5, 1.25, "boom", 7)
    assert rows(lineage.latest_runs(house.read("lineage.data_lineage")), "source_name", "status") == [("f.json", "error")]


def test_stream_loads_each_file_once(spark, house, tmp_path):
    folder, state = tmp_path / "in" / "books", str(tmp_path / "state")
    load = lambda: drops.load_new_files(house, "books", str(folder), state, RUN).awaitTermination()
    write_drop(tmp_path / "in", "books", "1.json", [item("1", 1, "2024-01-01"), item("2", 2, "2024-01-01")])
    write_drop(tmp_path / "in", "books", "bad.json", "oops")
    load()
    write_drop(tmp_path / "in", "books", "2.json", [item("2", 5, "2024-01-02"), item("3", 3, "2024-01-02")])
    load()
    load()
    assert rows(house.read("raw.books").select("product_id", F.col("price").cast("int"))) == [("1", 1), ("2", 5), ("3", 3)]
    assert house.count("lineage.change_tracking") == 4


def test_stream_first_seen_and_late_rows(spark, tmp_path):
    schema = "product_id string, source string, scraped_at timestamp"
    src, out, state = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "state")
    day = lambda d: datetime(2024, 1, d)

    def feed(*found):
        spark.createDataFrame(list(found), schema).coalesce(1).write.mode("append").parquet(src)
        drops.run_to_files(drops.first_seen(spark.readStream.schema(schema).parquet(src), "2 days"), out, state)

    feed(("1", "a", day(1)), ("1", "a", day(1)), ("1", "b", day(1)))
    feed(("1", "a", day(2)), ("2", "a", day(2)))
    assert rows(spark.read.parquet(out), "product_id", "source") == [("1", "a"), ("1", "b"), ("2", "a")]
    feed(("9", "z", day(20)))
    feed(("7", "late", day(1)))  # behind the watermark
    assert ("7", "late") not in rows(spark.read.parquet(out), "product_id", "source")


def test_file_results_count_keys_without_sorting_rows(spark):
    table = spark.createDataFrame(
        [("file:/d/a.json", "1", None), ("file:/d/a.json", "1", None), ("file:/d/a.json", None, None), ("file:/d/a.json", None, None),
         ("file:/d/a.json", None, "{z"), ("file:/d/b.parquet", None, "{y"), ("file:/d/b.parquet", None, "{x"), ("file:/d/c.json", "2", None)],
        f"_file string, product_id string, {files.CORRUPT} string")
    listed = spark.createDataFrame([(f"file:///d/{n}",) for n in ("a.json", "b.parquet", "c.json", "d.parquet", "e.json")], "_file string")
    found = raw_load.file_results(listed, "books", table, ("product_id",))
    assert sorted(rows(found.select("file", "status", "count", "error")), key=lambda r: r[0]) == [
        ("/d/a.json", "partial", 2, "1 records not readable as JSON"), ("/d/b.parquet", "error", 0, "{x"), ("/d/c.json", "success", 1, None),
        ("/d/d.parquet", "error", 0, "no rows"), ("/d/e.json", "success", 0, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "SortAggregate" in line and "product_id" in line]


def test_snapshots_of_all_shops_are_computed_once(spark, monkeypatch):
    from checks import queries
    from vitrine.sources import testdata
    asked, drop_items = [], testdata.drop_items
    monkeypatch.setattr(testdata, "drop_items", lambda *a: asked.append(a) or drop_items(*a))
    path = queries._write_drops(spark, "/root/testdata/sf0.001")
    written = [spark.read.format(kind).load(f"{path}/{shop}/*").count()
               for shop, kind in (("books", "json"), ("kabum", "json"), ("amazon", "parquet"), ("americanas", "parquet"))]
    assert len(asked) == 1 and sum(written) == drop_items(spark, "/root/testdata/sf0.001").count()
