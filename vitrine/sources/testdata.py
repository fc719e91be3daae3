"""The generic test tables (`<dir>/<table>.parquet`) in the shapes the jobs expect."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import brl, literal_map
from ..operators.upsert import add_cdc_columns
from ..schemas import SHOPS
from ..session import spread

RUN_TIME = datetime(2024, 1, 31, 6, 0, 0)
SEQUENCE = ("seq_order", "seq_line", "seq_supp")


def newest_first() -> list[Column]:
    """Tie-break that makes the order of a product's listings total."""
    return [F.col(c).desc() for c in SEQUENCE]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _shop() -> Column:
    number = F.col("l_suppkey") % 4
    return (F.when(number == 0, "amazon").when(number == 1, "americanas").when(number == 2, "kabum")
            .otherwise("books"))


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as price snapshots of four shops' products."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"), (unit * (1 - F.col("l_discount"))).alias("price"),
        unit.alias("original_price"), F.col("p_type").alias("category"), F.col("s_name").alias("seller"),
        _shop().alias("source"), (1 + F.col("p_size") % 5).cast("double").alias("rating"),
        F.col("l_linenumber").cast("int").alias("reviews_count"), F.col("l_shipdate").alias("scraped_at"),
        F.col("l_orderkey").alias("seq_order"), F.col("l_linenumber").alias("seq_line"),
        F.col("l_suppkey").alias("seq_supp"))


# Per shop, its columns as listing columns.
SHOP_COLUMNS = {
    "books": ("product_id", "name", "price", "rating", "category", "source", "scraped_at"),
    "amazon": ("product_id", "name", "price", "original_price", "rating", "reviews_count", "source", "scraped_at"),
    "americanas": ("product_id", "name", "brand", "price", "original_price as list_price",
                   "reviews_count as available_quantity", "category", "seller", "source", "scraped_at"),
    "kabum": ("product_id", "name", "brand", "price", "original_price as old_price", "reviews_count as stock",
              "category", "seller", "rating", "reviews_count", "source", "scraped_at"),
}


def raw(spark: SparkSession, sf: str, shop: str) -> DataFrame:
    """A shop's snapshots in its raw columns."""
    rows = listings(spark, sf).filter(F.col("source") == shop).selectExpr(*SHOP_COLUMNS[shop], *SEQUENCE)
    return add_cdc_columns(rows, RUN_TIME)


def all_raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {shop: raw(spark, sf, shop) for shop in SHOPS}


def drop_items(spark: SparkSession, sf: str, shop: str | None = None) -> DataFrame:
    """Snapshots with whole cents and a time of their own, as shops would export them."""
    micros = (F.unix_micros(F.col("scraped_at").cast("timestamp")) + F.col("seq_order") * 1000000
              + F.col("seq_line") * 1000 + F.col("seq_supp"))
    lines = spread(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate")).select(
        F.col("l_orderkey").alias("seq_order"), F.col("l_linenumber").alias("seq_line"),
        F.col("l_suppkey").alias("seq_supp"), F.col("l_partkey").cast("string").alias("product_id"),
        "l_suppkey", "l_extendedprice", F.col("l_shipdate").alias("scraped_at"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"), "p_name", "p_brand",
                                            "p_type", "p_size", "p_retailprice")
    rows = lines.withColumn("source", _shop())
    rows = rows if shop is None else rows.filter(F.col("source") == shop)
    return rows.join(parts, "product_id").select(
        "product_id", F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.col("l_extendedprice").alias("price"), F.col("p_retailprice").alias("original_price"),
        F.col("p_type").alias("category"), F.concat(F.lit("Seller "), "l_suppkey").alias("seller"), "source",
        (1 + F.col("p_size") % 5).alias("rating"), F.col("seq_line").alias("reviews_count"),
        F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("scraped_at"))


# Order branch.

def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"), F.col("n_name").alias("city"),
        F.col("r_name").alias("state"))


def raw_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey as product_id", "p_name as name", "p_type as category", "p_retailprice as price",
        "p_size as stock_quantity")


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as order_id", "o_custkey as customer_id", "o_orderdate as order_date",
        "o_orderstatus as status", "o_totalprice as total_amount")


def raw_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as order_id", "l_partkey as product_id", "l_quantity as quantity",
        "l_extendedprice / l_quantity as unit_price")


def lineage_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("source_name"), F.lit("file").alias("source_type"),
        F.lit("raw").alias("target_schema"),
        F.concat(F.lit("t"), (F.col("user_id") % 4).cast("string")).alias("target_table"),
        F.lit("load").alias("operation"), F.floor("value").cast("bigint").alias("record_count"),
        F.col("ts").alias("execution_time"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"))


# Payloads and pages rendered from line items, for the extraction jobs.

def _lines(spark: SparkSession, sf: str) -> DataFrame:
    money = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return spread(table(spark, sf, "lineitem")).join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("seq_order"), F.col("l_linenumber").alias("seq_line"),
        F.col("l_suppkey").alias("seq_supp"), F.col("l_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
        F.col("p_size").alias("size"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("price"),
        F.col("p_retailprice").alias("list_price"), F.col("l_quantity").cast("int").alias("quantity"),
        money.alias("cents"))


def vtex_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Per line a payload of four products: complete, without default seller, without items, without name. Lines
    numbered 7 have a payload that is no JSON."""
    offer = lambda price, listed: F.struct(price.alias("Price"), listed.alias("ListPrice"),
                                           F.col("quantity").alias("AvailableQuantity"))
    price, listed = F.col("price"), F.col("list_price")
    seller = lambda default, name, o: F.struct(default.alias("sellerDefault"), name.alias("sellerName"),
                                               o.alias("commertialOffer"))
    image = F.array(F.struct(F.concat(F.lit("https://img.example.org/"), "id").alias("imageUrl")))
    no_image = F.filter(image, lambda x: F.lit(False))
    main = seller(F.lit(True), F.concat(F.lit("Seller "), F.col("seq_supp")), offer(price, listed))
    other = seller(F.lit(False), F.lit("Other"), offer(listed, listed))
    full = F.array(F.struct(image.alias("images"), F.array(other, main).alias("sellers")))
    plain = F.array(F.struct(no_image.alias("images"), F.array(other, other).alias("sellers")))
    none = F.filter(plain, lambda x: F.lit(False))

    def product(prefix: str, name: Column, items: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), "id").alias("productId"), name.alias("productName"), F.col("brand"),
            F.array(F.concat(F.lit("/"), "type", F.lit("/Sub/"))).alias("categories"),
            F.replace(F.col("name"), F.lit(" "), F.lit("-")).alias("linkText"), items.alias("items"))

    body = F.to_json(F.array(product("", F.col("name"), full), product("b", F.col("name"), plain),
                             product("c", F.col("name"), none), product("d", F.lit(None).cast("string"), full)))
    return _lines(spark, sf).select(
        *SEQUENCE, F.when(F.col("line") == 7, "not json").otherwise(body).alias("body"))


def kabum_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Per line a payload of three products: complete, with the bare minimum, without title."""
    def product(title: Column, discounted: Column, rich: bool) -> Column:
        some = lambda c: c if rich else F.lit(None).cast("string")
        return F.struct(F.col("id").cast("bigint").alias("id"), F.struct(
            title.alias("title"), F.col("list_price").alias("price"), discounted.alias("price_with_discount"),
            F.col("list_price").alias("old_price"), F.col("line").alias("discount_percentage"),
            F.col("quantity").alias("stock"), some(F.concat(F.lit("Shop/"), "type")).alias("menu"),
            F.array(F.concat(F.lit("https://img.example.org/"), "id")).alias("images"),
            some(F.lit("/p")).alias("product_link"), F.struct(some(F.col("brand")).alias("name")).alias("manufacturer"),
            F.struct(some(F.concat(F.lit("Seller "), F.col("seq_supp"))).alias("seller_name")).alias("marketplace"),
            (1 + F.col("size") % 5 + F.lit(0.5)).alias("average_of_ratings"),
            F.col("size").alias("number_of_ratings")).alias("attributes"))

    body = F.to_json(F.struct(F.struct(F.lit(3).alias("total_items_count")).alias("meta"), F.array(
        product(F.col("name"), F.col("price"), True), product(F.upper("name"), F.lit(0.0), False),
        product(F.lit(""), F.col("price"), True)).alias("data")))
    return _lines(spark, sf).select(*SEQUENCE, body.alias("body"))


def _amount(cents: Column) -> Column:
    """Cents as a plain decimal text."""
    return F.concat(F.floor(cents / 100).cast("bigint"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def _page(lines: DataFrame, url: Column, *parts: str | Column) -> DataFrame:
    html = F.concat(F.lit("<!DOCTYPE html><html><body>"), *[F.lit(p) if isinstance(p, str) else p for p in parts],
                    F.lit("</body></html>"))
    return lines.select(*SEQUENCE, F.col("seq_order").alias("page_id"), url.alias("url"), html.alias("html"))


# Rating words by number.
WORDS = {1: "One", 2: "Two", 3: "Three", 4: "Four", 5: "Five"}


def book_pages(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf)
    word = literal_map(WORDS)[(1 + F.col("size") % 5).cast("int")]
    slug = F.replace(F.col("name"), F.lit(" "), F.lit("-"))
    href = F.concat(F.lit("catalogue/"), slug, F.lit("_"), "id", F.lit("/index.html"))
    return _page(
        lines, F.concat(F.lit("https://books.example.org/page-"), "seq_line", F.lit(".html")),
        '<section><ol><li><article class="product_pod"><div><a href="', href, '"><img class="thumbnail" src="media/',
        F.col("id"), '.jpg"></a></div><p class="star-rating ', word, '"></p><h3><a href="', href, '" title="',
        F.initcap("name"), '">', F.substring("name", 1, 5), '...</a></h3><p class="price_color">£',
        _amount(F.col("cents")), '</p><p class="instock availability">In stock</p></article></li></ol>',
        '<ul><li class="next"><a href="page-', (F.col("seq_line") + 1).cast("string"), '.html">next</a></li></ul>',
        "</section>")


def amazon_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One card with all fields and one without a product id per page."""
    lines = _lines(spark, sf)
    price = brl(F.col("price"))
    return _page(
        lines, F.lit("https://www.amazon.com.br/s?k=x"),
        '<div data-component-type="s-search-result"><div data-asin="', F.col("id"), '"><h2><a href="/dp/', F.col("id"),
        '"><span>', F.col("name"), '</span></a></h2><span class="a-price"><span class="a-offscreen">', price,
        '</span></span><span class="a-price a-text-price"><span class="a-offscreen">', brl(F.col("list_price")),
        '</span></span><span class="a-icon-alt">', (F.col("size") % 5).cast("string"),
        ',5 de 5 estrelas</span><span class="a-size-base s-underline-text">1.',
        F.lpad(F.col("size").cast("string"), 3, "0"), '</span><img class="s-image" src="i/', F.col("id"),
        '.jpg"></div></div><div data-component-type="s-search-result"><h2><span>ad</span></h2></div>')


def market_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Odd lines use the list layout, even ones the grid layout with the fallback elements; lines numbered 7 are
    verification pages."""
    lines = _lines(spark, sf)
    odd = F.col("line") % 2 == 1
    pick = lambda a, b: F.when(odd, F.lit(a)).otherwise(F.lit(b))
    reais = lambda cents: F.translate(F.format_number(F.floor(cents / 100).cast("bigint"), 0), ",", ".")
    url = F.concat(F.lit("https://lista.example.org/"),
                   F.when(F.col("line") == 7, "account-verification").otherwise("celular"))
    listed = F.round(F.col("list_price") * 100).cast("bigint")
    return _page(
        lines, url,
        pick('<ol><li class="ui-search-layout__item">', '<div class="ui-search-result">'), "<a class='",
        pick("ui-search-link", "ui-search-item__group__element"), "' href='https://p.example.org/MLB-", F.col("id"),
        "-x'>", pick('<h2 class="ui-search-item__title">', '<h3 class="ui-search-item__title">'), F.col("name"),
        pick("</h2>", "</h3>"), "</a>", '<span class="andes-money-amount__fraction">', reais(F.col("cents")),
        "</span>", pick("<del>", '<span class="ui-search-price__original-value">'),
        '<span class="andes-money-amount__fraction">', reais(listed), "</span>", pick("</del>", "</span>"),
        '<span class="ui-search-item__group__attributes">Novo</span>',
        '<span class="ui-search-item__group__attributes">', F.col("size").cast("string"), " vendidos</span>",
        pick('<span class="ui-search-item__shipping--free">Frete grátis</span>', ""), pick("</li></ol>", "</div>"))


def card_pages(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf)
    return _page(
        lines, F.concat(F.lit("https://shop.example.org/products?page="), "seq_line"),
        '<div class="product" data-id="', F.col("id"), '"><h2>  ', F.replace(F.col("name"), F.lit(" "), F.lit("  ")),
        '</h2><span class="price">', brl(F.col("price")), "</span><p>Marca &amp; tipo: ", F.col("brand"),
        '</p><img src="i/', F.col("id"), '.jpg"><a href="/product/', F.col("id"), '">ver</a></div>')


def detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf)
    return _page(
        lines, F.concat(F.lit("https://shop.example.org/product/"), "id"),
        '<link rel="canonical" href="https://shop.example.org/p/', F.col("id"), '"><main id="', F.col("id"),
        '"><div class="breadcrumb"><a>Home</a><a>', F.col("type"), '</a></div><h1>', F.col("name"),
        '</h1><div data-price="', _amount(F.col("cents")), '"></div><div class="description">', F.col("brand"),
        '</div><div class="gallery"><img src="g/', F.col("id"), '.jpg"></div></main>')


def link_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages without product cards that link to twelve products and one other page each."""
    lines = _lines(spark, sf)
    links = [p for i in range(12) for p in ('<a href="../product/', F.col("id"), f'/{i}">p</a>')]
    return _page(lines, F.concat(F.lit("https://shop.example.org/a/b/"), "seq_line", F.lit("?x=1")),
                 '<a href="/about">about</a>', *links)
