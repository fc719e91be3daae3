from pyspark.sql import functions as F
import pytest

from vitrine.functions import derive as dv, text as tx


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize("fn, cases", [
    (tx.clean_price, {"R$ 150,90": 150.9, "$1,299.99": 1299.99, "99.90": 99.9, None: None, "": None, "abc": None,
                      "  R$ 45,50  ": 45.5, "R$ 1.299,99": 1299.99, "-10": 10.0, "1,234,567": None, "1.2.3": None,
                      "12.": 12.0, ",": None}),
    (tx.clean_price_br, {"R$ 1.299,00": 1299.0, "99.90": 9990.0, "": None, None: None, "x": None}),
    (tx.clean_price_pounds, {"£51.77": 51.77, " £ 5 ": 5.0, "51,77": None, None: None, "nan": None}),
    (tx.clean_price_reais, {"R$ 2.584,32": 2584.32, "1.999": 1999.0, "USD 3": None, None: None}),
    (tx.clean_rating, {"4,5 de 5 estrelas": 4.5, "4.0": 4.0, "nenhum": None, "": None, None: None}),
    (tx.clean_integer, {"1.234 avaliacoes": 1234, "abc": None, "": None, None: None}),
    (tx.clean_text, {"  Produto   Legal  ": "Produto Legal", "a\n\nb": "a b", None: "", "": "", "a\t\tb": "a b",
                     " a  b": "a b"}),
    (tx.parse_date, {"2024-01-15": "2024-01-15T00:00:00", "15/01/2024": "2024-01-15T00:00:00",
                     "2024-01-15T10:30:00": "2024-01-15T10:30:00", "2024-1-5": "2024-01-05T00:00:00",
                     "not-a-date": None, "2024-13-40": None, None: None}),
    (tx.title_case, {"produto teste": "Produto Teste", "iphone 15pro": "Iphone 15Pro", "d'agua ÁGUA": "D'Agua Água",
                     "": "", None: None}),
    (tx.category_name, {"eletronicos": "Eletronicos", " ELETRÔNICOS ": "Eletronicos", "home": "Casa e Decoração",
                        "mesa posta": "Mesa Posta", "": "", None: None}),
    (tx.rating_number, {"Three": 3, " five ": 5, "4": 4, " +5 ": 5, "4.5": None, "6.7": None, "many": None, "": None, None: None}),
    (tx.source_address, {"https://example.com/products?page=1": "https://example.com/products",
                         "https://example.com/a//": "https://example.com/a", None: None}),
    (tx.id_from_href, {"catalogue/a-light_1000/index.html": "1000"}),
    (tx.marketplace_id, {"https://x/MLB-123-y": "MLB123", "https://x/MLB55": "MLB55", "https://x": "", None: ""}),
    (tx.rating_class, {"star-rating Three": "Three"}),
    (tx.number, {"1e3": 1000.0, "NaN": None, "12d": None, " 7 ": 7.0, "Infinity": None, "-1.5": -1.5}),
])
def test_text_functions(spark, fn, cases):
    assert apply(spark, fn, list(cases)) == list(cases.values())


@pytest.mark.parametrize("fn, cases", [
    (dv.rating_label, {None: "Sem avaliacao", 5.0: "Excelente", 4.0: "Excelente", 3.9: "Bom", 2.0: "Regular", 1.9: "Ruim"}),
    (dv.price_tier, {99.99: "Economico", 100.0: "Medio", 499.99: "Medio", 500.0: "Premium", 2000.0: "Luxo"}),
    (dv.customer_segment, {None: "Novo", 1.0: "Novo", 2.0: "Recorrente", 5.0: "Recorrente", 6.0: "VIP"}),
    (lambda p: dv.discount_percent(p, F.lit(100.0)), {75.0: 25.0, 100.0: 0.0, 120.0: 0.0}),
    (lambda p: dv.whole_discount(p, F.lit(80.0)), {70.0: 12, 90.0: -12, 0.0: None}),
    (lambda p: dv.discount_percent(p, F.lit(0.0)), {75.0: 0.0}),
    (lambda p: dv.against_average(F.lit(30.0), p), {20.0: 50.0, 0.0: 0.0, None: 0.0}),
    (tx.brl, {2584.32: "R$ 2.584,32", 0.5: "R$ 0,50", 1234567.0: "R$ 1.234.567,00"}),
])
def test_number_functions(spark, fn, cases):
    assert apply(spark, fn, list(cases), "double") == list(cases.values())


def test_item_hash_is_md5_of_id_and_source(spark):
    import hashlib
    df = spark.createDataFrame([("1", "a"), ("1", None)], "p string, s string")
    found = [r[0] for r in df.select(tx.item_hash(F.col("p"), F.col("s"))).collect()]
    assert found == [hashlib.md5(b"1:a").hexdigest(), hashlib.md5(b"1:").hexdigest()]


def test_missing_and_nan_numbers(spark):
    df = spark.createDataFrame([(float("nan"), "x", "7.9"), (2.0, "3", None)], "a double, b string, c string")
    out = df.select(dv.as_number(df, "a"), dv.as_number(df, "b"), dv.as_number(df, "zz"), dv.as_count(df, "c"))
    assert [tuple(r) for r in out.collect()] == [(None, None, None, 7), (2.0, 3.0, None, 0)]
