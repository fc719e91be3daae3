import json
import random

import pytest
from pyspark.sql import functions as F

from vitrine.session import spread
from vitrine.sources import html, markup, payloads
from vitrine.sources.payloads import capped

from conftest import rows


def bodies(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page int, body string")


def vtex(**changes):
    product = {"productId": "7000001", "productName": "Garden Lamp Verde", "brand": "Verde",
               "categories": ["/Garden/Lamps/"], "linkText": "garden-lamp",
               "items": [{"images": [{"imageUrl": "https://i/1.jpg"}], "sellers": [
                   {"sellerDefault": False, "sellerName": "B", "commertialOffer": {"Price": 1.0, "ListPrice": 2.0, "AvailableQuantity": 1}},
                   {"sellerDefault": True, "sellerName": "A", "commertialOffer": {"Price": 149.5, "ListPrice": 179.5, "AvailableQuantity": 5}}]}]}
    product.update(changes)
    return product


def test_vtex(spark):
    df = payloads.vtex_listings(bodies(spark, json.dumps([vtex(), vtex(productId="2", items=[]), vtex(productName="")])))
    assert [r.asDict() for r in df.orderBy("pos").collect()] == [
        {"page": 0, "pos": 0, "product_id": "7000001", "name": "Garden Lamp Verde", "brand": "Verde", "price": 149.5,
         "list_price": 179.5, "available_quantity": 5, "category": "Garden/Lamps", "image_url": "https://i/1.jpg",
         "url": "https://www.americanas.com.br/garden-lamp/p", "seller": "A", "source": "americanas"},
        {"page": 0, "pos": 1, "product_id": "2", "name": "Garden Lamp Verde", "brand": "Verde", "price": 0.0,
         "list_price": 0.0, "available_quantity": 0, "category": "Garden/Lamps", "image_url": "",
         "url": "https://www.americanas.com.br/garden-lamp/p", "seller": "", "source": "americanas"}]


def test_vtex_without_rows(spark):
    assert payloads.vtex_listings(bodies(spark, "[]", "not json", json.dumps(vtex()), None)).count() == 0


def kabum(**changes):
    attributes = {"title": "Desk Fan Nord", "price": 89.5, "price_with_discount": 79.5, "old_price": 99.5,
                  "discount_percentage": 10, "stock": 5, "menu": "Garden/Lamps", "images": ["https://i/k.jpg"],
                  "product_link": "fan", "manufacturer": {"name": "Nord"}, "marketplace": None,
                  "average_of_ratings": 4.5, "number_of_ratings": 7}
    attributes.update(changes)
    return {"id": 5550123, "attributes": attributes}


def test_kabum(spark):
    body = json.dumps({"meta": {"total_items_count": 4}, "data": [
        kabum(), kabum(price_with_discount=0, manufacturer="x", marketplace={"seller_name": "Loja"}, menu=None),
        kabum(title="")]})
    found = payloads.kabum_listings(bodies(spark, body)).orderBy("pos").collect()
    assert [(r.product_id, r.price, r.category, r.seller, r.brand, r.url, r.rating, r.reviews_count) for r in found] == [
        ("5550123", 79.5, "Lamps", "KaBuM", "Nord", "https://www.kabum.com.br/produto/5550123", 4.5, 7),
        ("5550123", 89.5, "", "Loja", "", "https://www.kabum.com.br/produto/5550123", 4.5, 7)]


def test_kabum_without_rows(spark):
    assert payloads.kabum_listings(bodies(spark, '{"meta": {}, "data": []}', "not json", None)).count() == 0


def pages(spark, *htmls, url="https://shop.example.org/all"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id int, url string, html string")


def test_product_card(spark):
    card = """<html><body><div class="product" data-id="x17"><h2>Blue Kettle</h2><span class="price">R$ 37,25</span>
      <span class="category">Kitchen</span><p>A kettle for the kitchen</p><img src="https://pictures.example.org/k.png">
      </div></body></html>"""
    found = html.card_listings(pages(spark, card, "<html><body><p>Nothing here</p></body></html>", "", None)).collect()
    assert [r.asDict() for r in found] == [{
        "page_id": 0, "pos": 0, "product_id": "x17", "name": "Blue Kettle", "price": 37.25, "category": "all",
        "description": "A kettle for the kitchen", "image_url": "https://pictures.example.org/k.png", "url": None,
        "source": "https://shop.example.org/all"}]


def test_broken_markup_of_any_depth(spark):
    deep = "<b>" * 5000 + '<div class="product" id="x"><h2>Deep</h2></div>' + "<p><p></i></b>"
    assert rows(html.card_listings(pages(spark, deep)), "product_id", "name") == [("x", "Deep")]


def test_market_fallbacks_and_verification(spark):
    grid = """<div class="ui-search-result"><a class="ui-search-item__group__element" href="https://p/MLB-9">
      <h3 class="ui-search-item__title">Celular</h3></a><span class="andes-money-amount__fraction">1.000</span></div>"""
    both = '<li class="ui-search-layout__item"><h2 class="ui-search-item__title">Lista</h2></li>' + grid
    assert rows(html.mercadolivre_listings(pages(spark, grid, both)), "page_id", "product_id", "name", "price") == [
        (0, "MLB9", "Celular", 1000.0), (1, "", "Lista", None)]
    barred = pages(spark, grid, url="https://www/account-verification?go=1")
    assert html.mercadolivre_listings(barred).count() == 0


CONFIG = {"selectors": {"item": "article.product_pod", "fields": {
    "product_id": {"css": "h3 a", "attr": "href", "processors": ["strip"]}, "name": {"css": "h3 a", "attr": "title"},
    "price": {"css": "p.price_color", "processors": ["clean_price"]}, "note": {"css": "p"}}}}


def test_configured_fields(spark, tmp_path):
    page = """<article class="product_pod"><h3><a href=" /x " title="A Book">A..</a></h3><p class="price_color">£51.77</p>
      <p>two</p></article><article class="product_pod"><h3></h3></article>"""
    for name in ("c.json", "c.yml"):
        (tmp_path / name).write_text(json.dumps(CONFIG))  # JSON is YAML too
        found = html.configured_listings(pages(spark, page), html.load_config(str(tmp_path / name))).collect()
        assert [(r.pos, r.product_id, r["name"], r.price, r.note) for r in found] == [(0, "/x", "A Book", 51.77, "£51.77 two")]
    with pytest.raises(ValueError):
        html.configured_listings(pages(spark, page), {"selectors": {}})


def test_links(spark):
    links = ["/a", "b?x=1", "../c/d", "#top", "?q=2", "//cdn.example.org/e", "https://other.example.org/f", "", "./g", "a&amp;b"]
    page = "<!-- <a href='no'> -->" + "".join(f"<a class='k' href='{h}'>x</a>" for h in links)
    found = html.page_links(pages(spark, page, url="https://example.com/p/q/r?s#t")).orderBy("pos").collect()
    assert [r.link for r in found] == [
        "https://example.com/a", "https://example.com/p/q/b?x=1", "https://example.com/p/c/d",
        "https://example.com/p/q/r?s#top", "https://example.com/p/q/r?q=2", "https://cdn.example.org/e",
        "https://other.example.org/f", "https://example.com/p/q/r?s#t", "https://example.com/p/q/g",
        "https://example.com/p/q/a&b"]


def test_product_links_only_without_cards(spark):
    anchors = "".join(f'<a href="/product/{i}">p</a>' for i in range(15)) + '<a href="/about">a</a>'
    card = '<div class="item"><h2>x</h2></div>'
    near = '<div class="product-list"></div>'
    found = html.product_links(pages(spark, anchors, card + anchors, near + anchors))
    assert rows(found.groupBy("page_id").count()) == [(0, 15), (2, 15)]
    assert html.product_links(pages(spark, anchors), first=10).count() == 10


def test_next_page(spark):
    page = '<ul><li class="next"><a href="page-2.html">n</a></li></ul>'
    assert rows(html.next_pages(pages(spark, page, "<p>end</p>"), html.BOOKS), "page_id", "link") == [
        (0, "https://shop.example.org/page-2.html")]


@pytest.mark.parametrize("css, expected", [
    ("p::text", ["one", "two", "four"]), (".k::text", ["two"]), ("div p::text", ["two", "four"]),
    ("[data-x]::attr(data-x)", ["1"]), ("a[href*='prod']::attr(href)", ["/product"]), ("b:last-child::text", ["y"]),
    ("p[class='k']::text, b::text", ["two", "x", "y"]), ("::attr(data-x), ::attr(id)", ["i", "1"])])
def test_selectors(css, expected):
    page = markup.parse("""<p>one</p><div id="i" data-x="1"><p class="k">two<i>three</i></p><p>four</p>
      <a href="/product">a</a><a href="/x">b</a><span><b>x</b><b>y</b></span></div>""")
    assert markup.values(page, [markup.compile_selector(css)])[0] == expected


def test_cap_holds_for_a_hot_source(spark):
    df = spark.range(3000).select(F.lit("hot").alias("source"), F.lit("q").alias("query"), F.col("id").alias("pos"))
    assert [r.pos for r in capped(df, ["source", "query"], ["pos"], 1500).orderBy("pos").collect()] == list(range(1500))


PLAIN = [
    '<div class="product" id="a">', "<div class='item x' data-id=\"&amp;1\">", "<p>", "</p>", "<li>", "<b>", "</b>", "text ", "&amp; x",
    '<a href="/product/1">', '<a href="x&lt;" HREF="product" title>', "</a>", "<br>", "<br/>", "<DIV>", "</DIV >", "</div>",
    '<script>var a="</p>";</script>', "<title>t</title>", "<!-- c -->", "<!doctype html>", '<span class="price">', "</span>"]
ODD = ["< ", "<", '"', "<a href=product>", "<?pi?>", "<script/>", "<!-- a -- b -->", "<title>t &lt; <b>u</title>", "</ p>", "<textarea>"]


def test_pages_are_read_as_the_tree_reads_them():
    cards = "div.product, div.item"
    profiles = [(html.CARDS.items, list(html.CARDS.fields.values())), (html.DETAIL.items, list(html.DETAIL.fields.values())),
                (("div", "p"), ["b:last-child::text, p::text", "div div a:last-child::attr(href)", "*::attr(class)", "::text"]),
                (None, [cards.replace(",", "::attr(class),") + "::attr(class)", "a[href*='product']::attr(href)"])]
    draw = random.Random(7)
    for turn in range(2000):
        parts = PLAIN + ODD if turn % 2 else PLAIN
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        items, fields = profiles[turn % len(profiles)]
        reader, page = markup.Reader(items, fields), markup.parse(text)
        tops = [page] if items is None else next(
            (hits for css in items if (hits := markup.select(page, markup.compile_selector(css)))), [])
        assert reader.read(text) == [markup.values(top, [markup.compile_selector(f) for f in fields]) for top in tops], text
        assert reader.read(None) == ([[[] for _ in fields]] if items is None else [])


def test_plain_pages_are_read_without_a_tree(spark, monkeypatch):
    monkeypatch.setattr(markup, "parse", None)
    page = "".join(PLAIN) + '<div class="item" id="z"><h2>x</h2></div>'
    reader = markup.Reader(html.CARDS.items, list(html.CARDS.fields.values()))
    assert reader.read(page)[-1][:2] == [["z"], ["x"]]


def test_pages_of_one_layout_are_looked_through_once(monkeypatch):
    monkeypatch.setattr(markup.Reader, "_scan", None)
    looked, layout = [], markup.Reader._layout
    monkeypatch.setattr(markup.Reader, "_layout", lambda self, numbers: looked.append(numbers) or layout(self, numbers))
    reader = markup.Reader(html.CARDS.items, list(html.CARDS.fields.values()))
    for i in range(50):
        page = f"""<title>t</title><div class='item' id="{i}&amp;'"><h2>n{i}&lt;</h2><img src='{i}"'></div><p class="item">{'x' * (i % 2)}"""
        found = dict(zip(html.CARDS.fields, reader.read(page)[0]))
        assert (found["product_id"], found["name"], found["image_url"]) == ([f"{i}&'"], [f"n{i}<"], [f'{i}"'])
    assert len(looked) == 1


def test_layouts_and_tags_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(markup.Reader, "REMEMBERED", 20)
    monkeypatch.setattr(markup.Reader, "LAYOUT_TAGS", 50)
    reader, draw = markup.Reader(("div.product", "div"), ["a::attr(href)", "::text", "[title]::attr(title)"]), random.Random(3)
    compiled = [markup.compile_selector(f) for f in ("a::attr(href)", "::text", "[title]::attr(title)")]
    some = ["<div class='product'>", '<div>', "</div>", "x", "<p>", "<li>", "</li>", "</a >", "<title>", "</title>", "&amp;", "<b title>"]
    for i in range(1500):
        new = [f'<a class="c{i}" href="{i}&gt;\'">', f"<a x{i % 90}='1'>", f'<a title="{i}" TITLE=\'2\'>', "<a href=", '<a "b', "<a 'b'>"]
        text = "".join(draw.choice(some if draw.random() < 0.9 else new) for _ in range(draw.randint(0, 12)))
        page = markup.parse(text)
        tops = next((hits for css in ("div.product", "div") if (hits := markup.select(page, markup.compile_selector(css)))), [])
        assert reader.read(text) == [markup.values(top, compiled) for top in tops], text
        assert len(reader.numbers) <= 20 and len(reader.kinds) <= 100 and reader.layout_tags <= 50


def test_what_a_task_holds_of_long_pages_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(html, "HELD_CHARS", 1000)
    monkeypatch.setattr(html, "HELD_ROWS", 3)
    card = '<div class="item" id="z"><h2>x</h2></div>'
    many = pages(spark, *[card * (i % 5) + "y" * 300 * (i % 3) for i in range(40)], None)
    found = html.extract(many.coalesce(1), html.CARDS)
    assert sorted(rows(found.groupBy("page_id").count())) == [(i, i % 5) for i in range(40) if i % 5]
    assert rows(found.select("pos").distinct()) == [(0,), (1,), (2,), (3,)]


def test_steps_up_of_links(spark):
    links = {"../x": "https://h/a/x", "../../x?q": "https://h/x?q", "../../../../x": "https://h/x", "../": "https://h/a/", "..": "https://h/a/",
             "../c/../d": "https://h/a/d", "../../": "https://h/"}
    page = "".join(f'<a href="{h}">x</a>' for h in links)
    found = html.page_links(pages(spark, page, url="https://h/a/b/c")).orderBy("pos").collect()
    assert [r.link for r in found] == list(links.values())


def test_rows_of_one_row_group_reach_all_tasks(spark, tmp_path):
    spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        dealt = spread(spark.read.parquet(str(tmp_path / "t")))
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 20000 and len(sizes) >= 8 and max(sizes) < 2 * min(sizes)
