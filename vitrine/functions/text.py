"""Column functions that read numbers, dates and identifiers out of scraped text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space as Python's str.strip understands it.
_SPACE = r"[\s\x1c-\x1f]+"
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Accepted date layouts, first match wins, and the ISO layout written.
DATE_LAYOUTS = ("yyyy-M-d", "d/M/yyyy", "yyyy-M-d'T'H:m:s")
ISO_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss"

# Category names by lower-case trimmed input.
CATEGORY_NAMES = {
    "eletronicos": "Eletronicos", "eletrônicos": "Eletronicos", "electronics": "Eletronicos",
    "casa": "Casa e Decoração", "home": "Casa e Decoração",
    "moda": "Moda", "fashion": "Moda",
    "esportes": "Esportes", "sports": "Esportes",
    "livros": "Livros", "books": "Livros",
    "alimentos": "Alimentos", "food": "Alimentos",
}

# Rating words.
RATING_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5}


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{_SPACE}|{_SPACE}$", "")


def present(text: Column) -> Column:
    """True for text that is neither NULL nor empty."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def number(text: Column) -> Column:
    """Text to double; anything but a plain decimal number (also 'NaN') gives NULL."""
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def clean_price(text: Column) -> Column:
    """Price text in Brazilian or US notation: the last separator is the decimal one, a lone comma too."""
    kept = F.regexp_replace(text, r"[^\d.,]", "")
    comma_last = kept.rlike(r",\d*$")
    return number(F.when(comma_last, F.translate(kept, ",.", ".")).otherwise(F.translate(kept, ",", "")))


def clean_price_br(text: Column) -> Column:
    """Price text where dots group thousands and the comma is decimal."""
    return number(F.translate(F.regexp_replace(text, r"[^\d.,]", ""), ",.", "."))


def clean_price_pounds(text: Column) -> Column:
    return number(F.replace(text, F.lit("£"), F.lit("")))


def clean_price_reais(text: Column) -> Column:
    """`R$` text: dots group thousands, comma is decimal, no other letters are tolerated."""
    return number(F.translate(F.replace(text, F.lit("R$"), F.lit("")), ",.", "."))


def clean_rating(text: Column) -> Column:
    """First number in a text such as '4,5 de 5 estrelas'."""
    return number(F.replace(F.regexp_extract(text, r"(\d+[.,]?\d*)", 1), F.lit(","), F.lit(".")))


def clean_integer(text: Column) -> Column:
    """All digits of a text, as one integer."""
    return F.regexp_replace(text, r"[^\d]", "").try_cast("bigint")


def clean_text(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(strip(text), rf"(?U){_SPACE}", " "), F.lit(""))


def parse_date(text: Column) -> Column:
    value = strip(text)
    parsed = F.coalesce(*[F.try_to_timestamp(value, F.lit(layout)) for layout in DATE_LAYOUTS])
    return F.date_format(parsed, ISO_LAYOUT)


def timestamp(value: Column) -> Column:
    return value.try_cast("timestamp")


def title_case(text: Column) -> Column:
    """A capital after every non-letter, the rest lower case."""
    letters = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = F.regexp_extract_all(text, F.lit(f"([{letters}]+|[^{letters}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def category_name(text: Column) -> Column:
    """The shop-independent category name; unknown names are put in title case, empty text stays."""
    known = F.try_element_at(literal_map(CATEGORY_NAMES), strip(F.lower(text)))
    return F.when(present(text), F.coalesce(known, title_case(text))).otherwise(text)


def rating_number(value: Column) -> Column:
    """Rating word or number to an integer. Numbers lose their fraction; text must be a whole number, else it is NULL."""
    text = strip(value.cast("string"))
    word = F.try_element_at(literal_map(RATING_WORDS), F.lower(text))
    whole = text.rlike(r"^[+-]?\d+$") | (F.typeof(value) != "string")
    return F.coalesce(word, F.when(whole, number(text).try_cast("int")))


def rating_class(css_class: Column) -> Column:
    return strip(F.replace(css_class, F.lit("star-rating"), F.lit("")))


def source_address(source: Column) -> Column:
    """A source address without its query string and trailing slashes."""
    return F.regexp_replace(F.substring_index(source, "?", 1), "/+$", "")


def item_hash(product_id: Column, source: Column) -> Column:
    return F.md5(F.concat(product_id, F.lit(":"), F.coalesce(source, F.lit(""))))


def id_from_href(href: Column) -> Column:
    return F.replace(F.substring_index(href, "_", -1), F.lit("/index.html"), F.lit(""))


def marketplace_id(link: Column) -> Column:
    return F.replace(F.regexp_extract(F.coalesce(link, F.lit("")), r"(MLB-?\d+)", 1), F.lit("-"), F.lit(""))


def brl(value: Column) -> Column:
    """Brazilian currency text, `R$ 2.584,32`."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(value, 2), ",.", ".,"))
