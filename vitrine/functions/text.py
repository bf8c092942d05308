"""Parsing of listing text: prices, sales volumes, ratings, brands, conditions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions import first_case

# Brand rules in order of precedence; the first title pattern
# that matches (case-insensitively) decides the brand.
BRAND_RULES = [
    ("Samsung", ["%Samsung%"]),
    ("Apple", ["%iPhone%", "Apple%"]),
    ("Motorola", ["Motorola%", "%Moto %"]),
    ("Xiaomi", ["Xiaomi%", "%Redmi%", "%POCO%"]),
    ("Realme", ["Realme%"]),
    ("LG", ["LG %", "Smartphone LG%"]),
    ("Sony", ["Sony%"]),
    ("Asus", ["Asus%", "%ZenFone%"]),
    ("Positivo", ["Positivo%"]),
]

# Spellings that mean a used item.
USED_CONDITIONS = ["usado", "used", "refurbished"]

# Words in the delivery text that mean free shipping.
FREE_SHIPPING_WORDS = ["grátis", "free"]


def parse_price(raw: Column) -> Column:
    """Brazilian price text to DOUBLE: ``R$ 1.999,00`` -> 1999.0.

    Only digits and commas count and the last comma is the decimal mark, so a
    US-style ``1299.00`` reads as 129900.  NULL when nothing parses.
    """
    digits = F.regexp_replace(raw, r"[^0-9,]", "")
    last_comma_only = F.regexp_replace(digits, r",(?=.*,)", "")
    return F.replace(last_comma_only, F.lit(","), F.lit(".")).try_cast("double")


def parse_sales_volume(text: Column, empty_as_zero: bool = False) -> Column:
    """Approximate units sold, from text such as ``Mais de 1,5 mil compras``.

    Default rule, in order: decimal followed by "mil", integer followed by
    "mil", all digits joined, NULL.  ``empty_as_zero`` selects the simpler rule
    of the collection step: integer followed by "mil", the first number, 0.
    Numbers beyond INT give NULL.
    """
    if empty_as_zero:
        thousands = F.regexp_extract(text, r"(?i)(\d+)\s*mil", 1).try_cast("bigint") * F.lit(1000)
        first = F.regexp_extract(text, r"(\d+)", 1).try_cast("bigint")
        return (
            F.when(text.rlike(r"(?i)\d+\s*mil"), thousands)
            .when(text.rlike(r"\d"), first)
            .otherwise(F.lit(0))
            .try_cast("int")
        )
    decimal_mil = r"(?i)(\d+)[,.](\d+)\s*mil"
    decimal_text = F.concat(
        F.regexp_extract(text, decimal_mil, 1), F.lit("."), F.regexp_extract(text, decimal_mil, 2)
    )
    integer_text = F.regexp_extract(text, r"(?i)(\d+)\s*mil", 1)
    return (
        F.when(text.rlike(decimal_mil), _thousands(decimal_text))
        .when(text.rlike(r"(?i)\d+\s*mil"), _thousands(integer_text))
        .when(text.rlike(r"\d"), F.regexp_replace(text, r"[^0-9]", "").try_cast("int"))
    )


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def _thousands(number_text: Column) -> Column:
    return F.round(number_text.try_cast("decimal(28,9)") * F.lit(1000), 0).try_cast("int")


def parse_rating(raw: Column) -> Column:
    """Star rating; missing or empty is 0.0, text that is no number is NULL."""
    return F.coalesce(F.nullif(raw, F.lit("")), F.lit("0")).try_cast("double")


def is_free_shipping(delivery: Column) -> Column:
    text = F.lower(F.coalesce(delivery, F.lit("")))
    return _any(text.contains(word) for word in FREE_SHIPPING_WORDS)


def brand_from_title(brand: Column, title: Column) -> Column:
    """The stated brand if any, else the first brand rule the title matches."""
    guess = first_case((_any(title.ilike(p) for p in patterns), name) for name, patterns in BRAND_RULES)
    return F.coalesce(F.nullif(brand, F.lit("")), guess)


def normalize_condition(condition: Column) -> Column:
    known = F.lower(F.coalesce(condition, F.lit("new")))
    return F.when(known.isin(USED_CONDITIONS), "used").otherwise("new")


def first_filled(text: Column, payload: Column, path: str) -> Column:
    """``text`` unless NULL or empty, else the value at ``path`` of a JSON payload."""
    return F.coalesce(F.nullif(text, F.lit("")), F.get_json_object(payload, path))
