"""Every job and operator as a query over the generic test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions import derive as dv, text as tx
from vitrine.operators import dedup, health, items, lineage, quality, upsert
from vitrine.plans import daily, marts, raw_load, reports, sales, staging
from vitrine.schemas import SHOPS, drop_schema
from vitrine.session import in_parallel, scratch_path, stored
from vitrine.sources import files, html, payloads, testdata as td
from vitrine.sources.catalog import Warehouse, row_counts
from vitrine.streaming import drops

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHOP3 = ("amazon", "americanas", "kabum")
AS_OF = datetime(2002, 1, 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _union(spark, sf, keep=()):
    return reports.all_listings(td.all_raw(spark, sf), keep)


def _all(spark, sf, keep=()):
    """The listings under display names in one scan."""
    rows = td.listings(spark, sf)
    label = tx.literal_map({s: d[0] for s, d in reports.DISPLAY.items()})[F.col("source")]
    fixed = F.when(F.col("source").isin("amazon", "kabum"), label).otherwise(F.col("category"))
    return rows.select("product_id", "name", "price", label.alias("source"), "scraped_at", fixed.alias("category"), *keep)


def _prices(spark, sf):
    """Source and price of all listings, written once for jobs that read them several times."""
    return stored(_all(spark, sf).select("source", "price"), "prices")


def _prepared(rows):
    """Listings that already have the common columns, as prepare_source gives them."""
    null = F.lit(None).cast("string")
    return rows.select("product_id", F.col("name").alias("product_name"), "brand", "price", "original_price", "category",
                       "seller", null.alias("image_url"), null.alias("url"), "source", "scraped_at", *td.SEQUENCE)


def _house(spark) -> Warehouse:
    return Warehouse(spark, f"w{uuid.uuid4().hex[:8]}_", scratch_path(spark, "tables"))


def _newest(spark, sf):
    rows = td.listings(spark, sf).filter(F.col("source").isin(*SHOP3))
    return marts.finish_products(_prepared(rows), td.newest_first())


# Marts and staging.

@query
def dim_products_latest(spark, sf):
    return _newest(spark, sf)


@query
def dim_products(spark, sf):
    shops = {s: td.raw(spark, sf, s) for s in SHOP3}
    return marts.dim_products(shops, td.newest_first(), td.SEQUENCE)


@query
def prepared_sources(spark, sf):
    parts = [marts.prepare_source(td.raw(spark, sf, s), s) for s in SHOP3]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def dim_books(spark, sf):
    books = staging.stg_books(td.raw(spark, sf, "books"))
    return marts.dim_books(books, td.newest_first())


def _staged(name):
    def run(spark, sf):
        newest = dedup.newest_per_key(td.raw(spark, sf, name), ["product_id"], td.newest_first())
        rows = staging.stg_books(newest) if name == "books" else staging.stg_shop(newest, name)
        return rows.drop("updated_at", "_extract_ts", "deleted_at")
    QUERIES[f"stg_{name}"] = run


for _shop in SHOPS:
    _staged(_shop)


@query
def newest_per_key(spark, sf):
    return dedup.newest_per_key(td.listings(spark, sf), ["product_id", "source"], td.newest_first())


@query
def first_items(spark, sf):
    rows = td.listings(spark, sf).withColumn("product_id", F.when(F.col("seq_line") != 1, F.col("product_id")))
    return dedup.first_per_item(rows, [*td.SEQUENCE, "name"])


@query
def category_avg_price(spark, sf):
    return marts.category_average(td.raw(spark, sf, "books"))


@query
def valid_listings(spark, sf):
    return marts.valid_listings(_prepared(td.listings(spark, sf))).drop(*td.SEQUENCE)


# Order branch.

def _facts(spark, sf):
    orders = sales.stg_orders(td.raw_orders(spark, sf))
    return sales.fact_orders(sales.int_order_items(orders, td.raw_order_items(spark, sf)))


@query
def stg_customers(spark, sf):
    return sales.stg_customers(td.raw_customers(spark, sf))


@query
def stg_products(spark, sf):
    return sales.stg_products(td.raw_products(spark, sf))


@query
def stg_orders(spark, sf):
    return sales.stg_orders(td.raw_orders(spark, sf))


@query
def int_order_items(spark, sf):
    return sales.int_order_items(sales.stg_orders(td.raw_orders(spark, sf)), td.raw_order_items(spark, sf))


@query
def fact_orders(spark, sf):
    return _facts(spark, sf)


@query
def customer_orders(spark, sf):
    return sales.customer_orders(_facts(spark, sf)).withColumn("total_spent", F.round("total_spent", 2))


@query
def dim_customers(spark, sf):
    customers = sales.stg_customers(td.raw_customers(spark, sf))
    return sales.dim_customers(customers, _facts(spark, sf)).withColumn("total_spent", F.round("total_spent", 2))


@query
def product_sales(spark, sf):
    return sales.product_sales(td.raw_order_items(spark, sf)).withColumn("total_revenue", F.round("total_revenue", 2))


@query
def dim_product_sales(spark, sf):
    products = sales.stg_products(td.raw_products(spark, sf))
    out = sales.dim_product_sales(products, td.raw_order_items(spark, sf))
    return out.withColumn("total_revenue", F.round("total_revenue", 2))


# Reports.

@query
def source_tier_report(spark, sf):
    return reports.by_source_and_tier(_newest(spark, sf))


@query
def price_by_source(spark, sf):
    return reports.price_by_source(td.listings(spark, sf))


@query
def books_by_category_source(spark, sf):
    return reports.by_category_and_source(td.raw(spark, sf, "books"))


@query
def filtered_price_by_source(spark, sf):
    return reports.filtered_price_by_source(td.listings(spark, sf), 0, 2000)


@query
def row_count_overview(spark, sf):
    raw = {f"raw.{s}": d for s, d in td.all_raw(spark, sf).items()}
    return row_counts({**raw, "marts.dim_products": _newest(spark, sf), "marts.dim_books": dim_books(spark, sf)})


@query
def run_report(spark, sf):
    return reports.run_report(td.all_raw(spark, sf), {
        "dim_books": dim_books(spark, sf), "dim_products": _newest(spark, sf)})


@query
def source_comparison(spark, sf):
    return reports.volume_comparison({s: td.raw(spark, sf, s) for s in SHOP3})


@query
def ratings_comparison(spark, sf):
    return reports.ratings_comparison({s: td.raw(spark, sf, s) for s in SHOP3})


@query
def all_listings(spark, sf):
    return _union(spark, sf)


@query
def distinct_sources(spark, sf):
    return reports.sources(_all(spark, sf))


@query
def price_bounds(spark, sf):
    return reports.price_bounds(_all(spark, sf))


@query
def filtered_listings(spark, sf):
    return reports.filtered(_all(spark, sf), ["Books", "KaBuM"], 1000, 3000)


@query
def kpis(spark, sf):
    return reports.kpis(_all(spark, sf)).withColumn("avg_price", F.round("avg_price", 6))


@query
def kpi_texts(spark, sf):
    return reports.kpi_texts(_all(spark, sf))


@query
def volume_by_source(spark, sf):
    return reports.volume_by_source(_all(spark, sf))


@query
def timeline(spark, sf):
    return reports.timeline(_all(spark, sf))


@query
def price_stats_by_source(spark, sf):
    return reports.price_stats(_prices(spark, sf))


@query
def price_box_stats(spark, sf):
    box = reports.price_box(_prices(spark, sf))
    return box.select("source", "n", *[F.round(c, 6).alias(c) for c in
                                       ("q1", "median", "q3", "lower_whisker", "upper_whisker")])


@query
def price_histogram(spark, sf):
    bins = reports.price_histogram(_prices(spark, sf))
    return bins.select("bin", "n", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"))


@query
def avg_price_by_source(spark, sf):
    return reports.avg_price(_all(spark, sf)).withColumn("price", F.round("price", 6))


@query
def top10_expensive(spark, sf):
    return reports.most_expensive(_all(spark, sf, td.SEQUENCE), 10, td.newest_first())


@query
def top10_categories(spark, sf):
    return reports.largest_categories(_all(spark, sf))


@query
def top10_categories_price(spark, sf):
    return reports.dearest_categories(_all(spark, sf)).withColumn("avg_price", F.round("avg_price", 6))


@query
def price_sample(spark, sf):
    return reports.price_sample(_all(spark, sf, td.SEQUENCE), 500, 42)


@query
def category_source_matrix(spark, sf):
    matrix = reports.category_matrix(_all(spark, sf))
    return matrix.select("category", *[F.round(n, 6).alias(n) for n in reports.DISPLAY_NAMES])


@query
def currency_table(spark, sf):
    return reports.currency_table(td.drop_items(spark, sf).select("product_id", "name", "source", "scraped_at", "price"))


@query
def dashboard_tables(spark, sf):
    """All dashboard tables written, then their row counts."""
    house = _house(spark)
    names = reports.dashboard(house, td.all_raw(spark, sf))
    return row_counts({name: spark.table(table) for name, table in names.items()})


# Lineage.

@query
def lineage_summary(spark, sf):
    return lineage.run_summary(td.lineage_rows(spark, sf))


@query
def lineage_daily(spark, sf):
    return lineage.daily_stats(td.lineage_rows(spark, sf), date(2024, 1, 15))


@query
def lineage_latest(spark, sf):
    return lineage.latest_runs(td.lineage_rows(spark, sf), 100)


@query
def lineage_table(spark, sf):
    """Lineage rows as stored, without the engine-specific id."""
    return lineage.with_lineage_id(td.lineage_rows(spark, sf)).select(
        "source_name", "source_type", "target_schema", "target_table", "operation", "record_count",
        "execution_time", "status")


# Merges.

_CUT = "1999-01-01"
_KEYS = ["product_id", "source"]


def _merge_sides(spark, sf):
    rows = td.listings(spark, sf)
    old = dedup.newest_per_key(rows.filter(F.col("scraped_at") < _CUT), _KEYS, td.newest_first())
    new = dedup.newest_per_key(rows.filter(F.col("scraped_at") >= _CUT), _KEYS, td.newest_first())
    return old, new.drop("seller", "seq_order", "seq_line", "seq_supp")


@query
def upsert_result(spark, sf):
    old, new = _merge_sides(spark, sf)
    house = _house(spark)
    for day, batch in enumerate((old, new)):
        raw_load.upsert_table(house, "raw.listings", batch, td.RUN_TIME + timedelta(days=day), tuple(_KEYS), track_changes=False)
    return house.read("raw.listings").select(*old.columns)


@query
def insert_only_result(spark, sf):
    old, new = _merge_sides(spark, sf)
    return upsert.insert_only(old, new, _KEYS)


@query
def change_rows(spark, sf):
    old, new = _merge_sides(spark, sf)
    rows = upsert.change_rows(old, new, _KEYS, "raw.listings", td.RUN_TIME)
    return rows.select("source_table", "source_key", "operation", "changed_at")


@query
def cdc_columns(spark, sf):
    return upsert.add_cdc_columns(td.listings(spark, sf).select("product_id", "source", "scraped_at"), td.RUN_TIME)


# Items.

def _dirty(spark, sf):
    """Items as text: odd spacing and case, category synonyms, missing and bad values."""
    line = F.col("seq_line")
    synonyms = {"STANDARD": " Eletrônicos ", "ECONOMY": "HOME", "MEDIUM": "fashion", "LARGE": "sports",
                "SMALL": "Books", "PROMO": "mesa posta"}
    return td.drop_items(spark, sf).withColumnRenamed("reviews_count", "seq_line").withColumns({
        "product_id": F.when(line != 2, F.col("product_id")),
        "name": F.when(line == 3, "").otherwise(F.concat(F.lit("  "), F.upper("name"), F.lit(" "))),
        "category": tx.literal_map(synonyms)[F.col("category")],
        "price": F.when(line == 4, "invalido").when(line == 5, "0").otherwise(tx.brl(F.col("price"))),
        "rating": tx.literal_map({1: "one", 2: "Two ", 3: "THREE", 4: "4", 5: "many"})[F.col("rating")],
        "source": F.concat(F.lit("https://"), "source", F.lit(".example.org/list//?page="), line),
        "scraped_at": F.when(line != 6, F.col("scraped_at"))})


_ITEM = ("product_id", "name", "category", "price", "rating", "source", "scraped_at")


@query
def clean_items(spark, sf):
    return items.clean_items(_dirty(spark, sf), td.RUN_TIME).select(*_ITEM)


@query
def valid_items(spark, sf):
    return items.valid_items(items.clean_items(_dirty(spark, sf), td.RUN_TIME)).select(*_ITEM)


@query
def rejected_items(spark, sf):
    cleaned = items.clean_items(_dirty(spark, sf), td.RUN_TIME)
    return items.rejected_items(cleaned).select("product_id", "name", "price", "reject_reason")


@query
def item_chain(spark, sf):
    """Which items survive, in order of price, time and name."""
    arrival = ["price", "scraped_at", "name", "category", "rating"]
    return items.item_chain(_dirty(spark, sf), td.RUN_TIME, arrival).select(*_ITEM)


# Scalar functions.

def _cents(spark, sf):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    whole, part = F.floor(cents / 100).cast("bigint"), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.format_number(whole, 0)
    return td.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", cents.alias("cents"),
        whole.cast("string").alias("whole"), part.alias("part"), grouped.alias("us"),
        F.translate(grouped, ",", ".").alias("br"))


_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query
def scalar_prices(spark, sf):
    rows = _cents(spark, sf)
    join = lambda *p: F.concat(*[F.lit(x) if x in ("R$ ", "$", "£", ",", ".", "-") else F.col(x) for x in p])
    return rows.select(
        *_LINE,
        tx.clean_price(join("R$ ", "br", ",", "part")).alias("brazilian"),
        tx.clean_price(join("$", "us", ".", "part")).alias("american"),
        tx.clean_price(join("whole", ",", "part")).alias("comma"),
        tx.clean_price(join("-", "whole", ".", "part")).alias("unsigned"),
        tx.clean_price(join("whole", ".", "part", ".", "part")).alias("two_points"),
        tx.clean_price_br(join("R$ ", "br", ",", "part")).alias("br_only"),
        tx.clean_price_pounds(join("£", "whole", ".", "part")).alias("pounds"),
        tx.clean_price_reais(join("R$ ", "br", ",", "part")).alias("reais"),
        tx.clean_price_reais(join("$", "whole", ",", "part")).alias("reais_bad"),
        tx.number(join("whole", ".", "part")).alias("numeric"),
        tx.number(F.concat("whole", F.lit("x"))).alias("numeric_bad"))


@query
def scalar_ratings(spark, sf):
    rows = td.table(spark, sf, "lineitem").select(*_LINE)
    digit = F.col("l_linenumber").cast("string")
    word = tx.literal_map({**td.WORDS, 6: "6.7", 7: "none"})[F.col("l_linenumber")]
    return rows.select(
        *_LINE, tx.clean_rating(F.concat(digit, F.lit(",5 de 5 estrelas"))).alias("rating"),
        tx.clean_rating(F.lit("sem nota")).alias("no_rating"),
        tx.clean_integer(F.concat(digit, F.lit("."), F.lpad(digit, 3, "0"), F.lit(" opinioes"))).alias("reviews"),
        tx.clean_integer(F.lit("nenhuma")).alias("no_reviews"),
        tx.rating_number(word).alias("word"), tx.rating_class(F.concat(F.lit("star-rating "), word)).alias("css_word"))


@query
def scalar_texts(spark, sf):
    rows = td.table(spark, sf, "part")
    pid = F.col("p_partkey").cast("string")
    spaced = F.concat(F.lit(" \n"), F.replace("p_name", F.lit(" "), F.lit(" \t ")), F.lit(" "))
    return rows.select(
        "p_partkey", tx.clean_text(spaced).alias("collapsed"), tx.clean_text(F.lit(None).cast("string")).alias("nothing"),
        tx.title_case(F.concat(F.upper("p_name"), F.lit(" 15pro d'agua"))).alias("title"),
        tx.category_name(F.when(F.col("p_type") == "PROMO", " Home").otherwise(F.col("p_type"))).alias("category"),
        tx.source_address(F.concat(F.lit("https://x.example.org/"), pid, F.lit("//?page=2"))).alias("address"),
        tx.item_hash(pid, F.col("p_brand")).alias("item_key"),
        tx.id_from_href(F.concat(F.lit("catalogue/a_b_"), pid, F.lit("/index.html"))).alias("href_id"),
        tx.marketplace_id(F.concat(F.lit("https://x/MLB-"), pid, F.lit("-y"))).alias("market_id"),
        tx.marketplace_id(F.concat(F.lit("https://x/"), pid)).alias("no_market_id"),
        dv.book_key(pid).alias("book_id"), dv.listing_key(pid, F.col("p_brand")).alias("listing_id"))


@query
def scalar_dates(spark, sf):
    rows, ship = td.table(spark, sf, "lineitem"), F.col("l_shipdate")
    return rows.select(
        *_LINE, tx.parse_date(F.date_format(ship, "yyyy-M-d")).alias("iso_day"),
        tx.parse_date(F.date_format(ship, "dd/MM/yyyy")).alias("br_day"),
        tx.parse_date(F.date_format(ship, "yyyy-MM-dd'T'10:30:00")).alias("iso_time"),
        tx.parse_date(F.date_format(ship, "yyyy.MM.dd")).alias("bad"),
        tx.timestamp(F.date_format(ship, "yyyy-MM-dd HH:mm:ss")).alias("stamp"),
        tx.timestamp(F.lit("soon")).alias("bad_stamp"), F.to_date(ship).alias("day"))


@query
def scalar_labels(spark, sf):
    rows = td.table(spark, sf, "lineitem")
    price, line = F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_linenumber")
    rating = F.when(line != 7, (line - 1).cast("double"))
    return rows.select(
        *_LINE, dv.rating_label(rating).alias("rating_label"), dv.price_tier(price / 20).alias("price_tier"),
        dv.customer_segment(line).alias("segment"), dv.discount_percent(price, F.col("l_extendedprice")).alias("discount"),
        dv.whole_discount(price, F.col("l_extendedprice")).alias("whole_discount"),
        dv.against_average(F.col("l_quantity"), F.lit(25.0)).alias("against_average"),
        dv.line_total(F.col("l_quantity"), F.col("l_tax")).alias("line_total"),
        dv.or_zero(rating).alias("rating_or_zero"), tx.brl(F.col("l_extendedprice")).alias("currency"))


# Extraction.

@query
def vtex_listings(spark, sf):
    return payloads.vtex_listings(td.vtex_payloads(spark, sf))


@query
def kabum_listings(spark, sf):
    return payloads.kabum_listings(td.kabum_payloads(spark, sf))


@query
def book_page_listings(spark, sf):
    return html.book_listings(td.book_pages(spark, sf)).drop("page_id")


@query
def amazon_page_listings(spark, sf):
    return html.amazon_listings(td.amazon_pages(spark, sf)).drop("page_id")


@query
def market_page_listings(spark, sf):
    return html.mercadolivre_listings(td.market_pages(spark, sf)).drop("page_id")


@query
def card_page_listings(spark, sf):
    return html.card_listings(td.card_pages(spark, sf), "promo").drop("page_id")


@query
def detail_page_listings(spark, sf):
    return html.detail_listings(td.detail_pages(spark, sf)).drop("page_id")


@query
def configured_listings(spark, sf):
    config = {"selectors": {"item": "nav li", "fields": {
        "name": {"css": "a", "processors": ["strip"]}, "link": {"css": "a", "attr": "href"},
        "price": {"css": ".price", "processors": ["clean_price"]}}}}
    return html.configured_listings(td.table(spark, sf, "pages"), config).drop("source")


@query
def page_titles(spark, sf):
    """The detail profile over whole real pages: their first heading."""
    return html.detail_listings(td.table(spark, sf, "pages")).select(
        "page_id", "name", "product_id", "price", "source")


@query
def html_links(spark, sf):
    return html.page_links(td.table(spark, sf, "pages")).select("page_id", "pos", "href", "link")


@query
def product_page_links(spark, sf):
    return html.product_links(td.link_pages(spark, sf)).drop("page_url")


@query
def next_page_links(spark, sf):
    return html.next_pages(td.book_pages(spark, sf), html.BOOKS).drop("page_url")


@query
def capped_listings(spark, sf):
    rows = td.listings(spark, sf).select("source", "category", "product_id", *td.SEQUENCE)
    return payloads.capped(rows, ["source", "category"], [*td.SEQUENCE, "product_id"], 100)


# Files and tables.

@query
def json_drop_files(spark, sf):
    """Items written as JSON lines, read back with the drop schema and typed."""
    path = scratch_path(spark, "json-drops")
    written = files.export_items(td.drop_items(spark, sf), path, "kabum", td.RUN_TIME, ("json",))
    rows = files.read_json_drops(spark, drop_schema("kabum"), *written, lines=True)
    return files.coerce_to_raw(rows, "kabum").select(
        "product_id", "name", "brand", "price", "category", "seller", "rating", "reviews_count", "source", "scraped_at")


@query
def parquet_drop_files(spark, sf):
    path = scratch_path(spark, "parquet-drops")
    written = files.export_items(td.drop_items(spark, sf), path, "amazon", td.RUN_TIME, ("parquet",))
    rows = files.read_parquet_drops(spark, drop_schema("amazon"), *written)
    return files.coerce_to_raw(rows, "amazon").select(
        "product_id", "name", "price", "original_price", "rating", "reviews_count", "source", "scraped_at")


@query
def csv_export(spark, sf):
    path = scratch_path(spark, "csv")
    rows = td.listings(spark, sf).select("product_id", "name", "brand", "price", "source", "scraped_at")
    files.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).option("timestampFormat", files.ISO_OUT).csv(path)


@query
def json_export(spark, sf):
    path = scratch_path(spark, "json")
    rows = td.listings(spark, sf).select("product_id", "name", "brand", "price", "source", "scraped_at")
    files.write_json(rows, path)
    return spark.read.schema(rows.schema).option("timestampFormat", files.ISO_OUT).json(path)


def _write_drops(spark, sf, shops=SHOPS, snapshots=None) -> str:
    """Drop files of the shops, of `snapshots` if these are stored already; they are computed once, not per shop."""
    path = scratch_path(spark, "drops")
    renamed = {"americanas": {"original_price": "list_price", "reviews_count": "available_quantity"},
               "kabum": {"original_price": "old_price"}}
    snapshots = stored(td.drop_items(spark, sf), "snapshots") if snapshots is None else snapshots

    def write(shop: str) -> None:
        rows = snapshots.filter(F.col("source") == shop).withColumnsRenamed(renamed.get(shop, {}))
        if shop == "kabum":
            rows = rows.withColumn("stock", F.col("reviews_count"))
        files.export_items(rows, path, shop, td.RUN_TIME, ("json",) if shop in ("books", "kabum") else ("parquet",))

    in_parallel(spark, write, shops)
    return path


@query
def raw_load_tables(spark, sf):
    """Drop files of four shops loaded into raw tables: the newest row per product and source."""
    house = _house(spark)
    raw_load.load_directory(house, _write_drops(spark, sf), td.RUN_TIME)
    columns = ("product_id", "name", "price", "rating", "source", "scraped_at", "_extract_ts")
    parts = [house.read(f"raw.{s}") for s in SHOPS]
    parts = [(p if "rating" in p.columns else p.withColumn("rating", F.lit(None))).select(
        *[F.col(c).cast("double").alias(c) if c in ("price", "rating") else F.col(c) for c in columns]) for p in parts]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def daily_run_products(spark, sf):
    """The whole gated run: files to raw, staging, marts, report; checks in between. Gives the reported products."""
    house = _house(spark)
    snapshots = stored(td.drop_items(spark, sf), "snapshots")
    newest = snapshots.agg(F.max("scraped_at")).first()[0]
    run_time = datetime.strptime(newest[:19], "%Y-%m-%d %H:%M:%S") + timedelta(hours=1)
    daily.daily_run(house, _write_drops(spark, sf, snapshots=snapshots), run_time)
    return house.read("report.dim_products").select(
        "id", "product_name", "brand", "price", "original_price", "discount_percentage", "category", "seller",
        "source", "price_tier", "scraped_at")


@query
def stage_check_rows(spark, sf):
    """What the daily run records after loading, transforming and publishing. How many files were loaded, and so the text of
    the lineage check, depends on the cores that wrote them."""
    house = _house(spark)
    snapshots = stored(td.drop_items(spark, sf), "snapshots")
    newest = snapshots.agg(F.max("scraped_at")).first()[0]
    run_time = datetime.strptime(newest[:19], "%Y-%m-%d %H:%M:%S") + timedelta(hours=1)
    daily.daily_run(house, _write_drops(spark, sf, snapshots=snapshots), run_time)
    return house.read("lineage.stage_checks").select(
        "stage", "test", "status", F.when(F.col("test") != "lineage_exists", F.col("message")).alias("message"))


# Checks.

def _tables(spark, sf):
    raws = td.all_raw(spark, sf)
    staged = {s: (staging.stg_books if s == "books" else lambda d, s=s: staging.stg_shop(d, s))(
        dedup.newest_per_key(d, ["product_id"], td.newest_first())) for s, d in raws.items()}
    tables = {f"raw.{s}": d for s, d in raws.items()}
    tables.update({f"staging.stg_{s}": d for s, d in staged.items()})
    tables["marts.dim_books"] = dim_books(spark, sf)
    tables["marts.dim_products"] = _newest(spark, sf)
    tables["lineage.data_lineage"] = td.lineage_rows(spark, sf)
    return tables


@query
def quality_suite(spark, sf):
    return quality.run_checks(spark, quality.full_suite(), _tables(spark, sf).get)


@query
def mart_quality_suite(spark, sf):
    return quality.run_checks(spark, quality.mart_suite(), _tables(spark, sf).get)


def _snapshot_checks():
    c = quality.Check
    return [c("extract", "rows", "listings", min_rows=1000), c("load", "not_null", "listings", "seller"),
            c("transform", "duplicates", "listings", "product_id"), c("load", "unique", "listings", "product_id"),
            c("load", "positive", "listings", "price"), c("transform", "numeric", "listings", "name"),
            c("transform", "numeric", "listings", "product_id"),
            c("load", "in_set", "listings", "source", values=quality.MART_SOURCES),
            c("load", "references", "items", "order_id", parent="orders"),
            c("extract", "rows", "missing_table")]


@query
def snapshot_checks(spark, sf):
    """Checks that find something: every product occurs more than once, orders are missing, one table too."""
    tables = {"listings": td.listings(spark, sf), "items": td.raw_order_items(spark, sf),
              "orders": td.raw_orders(spark, sf)}
    return quality.run_checks(spark, _snapshot_checks(), tables.get)


@query
def definition_checks(spark, sf):
    """Keys, parents and text lengths of the order tables, by their definitions."""
    null = F.lit(None).cast("string")
    tables = {
        "raw.customers": td.raw_customers(spark, sf).withColumns({"email": null, "phone": null}),
        "raw.products": td.raw_products(spark, sf), "raw.orders": td.raw_orders(spark, sf),
        "raw.order_items": td.raw_order_items(spark, sf).withColumn("order_item_id", F.col("order_id"))}
    return quality.run_checks(spark, [c for t in tables for c in quality.definition_checks(t)], tables.get)


@query
def failed_checks(spark, sf):
    return quality.failed(snapshot_checks(spark, sf)).select("stage", "test")


@query
def check_pass_count(spark, sf):
    return quality.pass_count(snapshot_checks(spark, sf))


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(td.listings(spark, sf), "product_id")


@query
def orphan_keys(spark, sf):
    """Items without a finished order: the parent is thinner than the table, so that there are orphans to find."""
    finished = td.raw_orders(spark, sf).filter("status = 'F'")
    return quality.orphans(td.raw_order_items(spark, sf), "order_id", finished, "order_id")


@query
def freshness(spark, sf):
    return health.freshness(td.listings(spark, sf), AS_OF)


@query
def latest_scrapes(spark, sf):
    return td.listings(spark, sf).groupBy("source").agg(F.max("scraped_at").alias("last_scraped"))


def _health(spark, sf):
    tables = _tables(spark, sf)
    tables["raw.kabum"] = None
    return health.full_check(spark, tables.get, AS_OF)


@query
def health_checks(spark, sf):
    return _health(spark, sf).select("check", "passed", "message")


@query
def health_alerts(spark, sf):
    return health.alerts(_health(spark, sf), AS_OF)


@query
def health_of_any_table(spark, sf):
    """Freshness, size and key of staging and mart tables, by limits of their own."""
    tables = _tables(spark, sf)
    parts = [health.table_checks(spark, f"staging.stg_{s}", tables[f"staging.stg_{s}"], AS_OF, 24, 100) for s in SHOPS]
    parts.append(health.table_checks(spark, "marts.dim_products", tables["marts.dim_products"], AS_OF, 100_000, 10_000_000))
    parts.append(health.mart_checks(spark, "stg_books", "product_id", tables["staging.stg_books"], "staging"))
    return reduce(DataFrame.unionByName, parts).select("check", "passed", "message")


@query
def health_summary(spark, sf):
    return health.summary(_health(spark, sf))


# Streams.

def _event_stream(spark, sf, max_files=1000):
    """Events in one folder per day, read as a stream, at most `max_files` files a micro-batch."""
    path = scratch_path(spark, "events")
    rows = td.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("product_id"), F.col("event_type").alias("source"),
        F.col("ts").alias("scraped_at"), F.to_date("ts").alias("day"))
    rows.repartition("day").write.partitionBy("day").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max_files).parquet(path)


@query
def stream_daily_volume(spark, sf):
    """All days and sources, the last counts of each, after several micro-batches."""
    out = scratch_path(spark, "volume")
    drops.run_updates(drops.daily_volume(_event_stream(spark, sf, 10), "3650 days"), out, f"{out}-state")
    return drops.latest_updates(spark, out, ["scraped_date", "source"], "scraped_date timestamp, source string, count bigint")


@query
def stream_first_seen(spark, sf):
    out = scratch_path(spark, "seen")
    drops.run_to_files(drops.first_seen(_event_stream(spark, sf), "60 days"), out, f"{out}-state")
    return spark.read.schema("product_id string, source string").parquet(out)


@query
def stream_all_shops(spark, sf):
    """New drop files of all four shops, JSON lines and Parquet, merged into raw tables by one stream a shop."""
    house, path = _house(spark), _write_drops(spark, sf)
    state = scratch_path(spark, "shops-state")
    running = [drops.load_new_files(house, s, f"{path}/{s}/*", f"{state}/{s}", td.RUN_TIME) for s in SHOPS]
    for stream in running:
        stream.awaitTermination()
    columns = ("product_id", "name", F.col("price").cast("double").alias("price"), "source", "scraped_at")
    return reduce(DataFrame.unionByName, [house.read(f"raw.{s}").select(*columns) for s in SHOPS])


@query
def stream_raw_load(spark, sf):
    """New drop files merged into a raw table by a stream."""
    house, path = _house(spark), scratch_path(spark, "stream-drops")
    td.drop_items(spark, sf, "books").write.json(path)
    drops.load_new_files(house, "books", path, f"{path}-state", td.RUN_TIME).awaitTermination()
    return house.read("raw.books").select("product_id", "name", F.col("price").cast("double").alias("price"),
                                          F.col("rating").cast("bigint").alias("rating"), "source", "scraped_at")
