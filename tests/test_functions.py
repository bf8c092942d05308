from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vitrine.functions import labels
from vitrine.functions.numeric import half_up, mean, pct_change, share
from vitrine.functions.statistics import correlation_strength, pearson
from vitrine.functions.text import (
    brand_from_title, first_filled, is_free_shipping, normalize_condition, parse_price, parse_rating,
    parse_sales_volume,
)


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_price_text(spark):
    cases = {
        "R$ 661,50": 661.50, "R$ 1.299,00": 1299.0, "R$ 1.999,00": 1999.0, None: None, "": None, "abc": None,
        "1,299,00": 1299.0, ",50": 0.5, ",": None,
        # US notation: the comma is taken for the decimal mark, the dot is dropped
        "1,299.00": 1.299, "1299.00": 129900.0,
    }
    assert apply(spark, parse_price, list(cases)) == list(cases.values())


def test_sales_volume(spark):
    cases = {
        "Mais de 1 mil compras no mês passado": 1000, "Mais de 1,5 mil compras no mês passado": 1500,
        "Mais de 500 compras no mês passado": 500, "": None, None: None, "2 MIL": 2000, "1,5 MIL": 1500,
        "2 milhões": 2000, "500 compras em 30 dias": 50030, "1.000": 1000, "12345678901": None, "1,2345 mil": 1235,
        "muitas": None,
    }
    assert apply(spark, parse_sales_volume, list(cases)) == list(cases.values())


def test_sales_volume_first_number(spark):
    cases = {
        "Mais de 2 mil compras no mês passado": 2000, "Mais de 500 compras no mês passado": 500, "": 0, None: 0,
        "1,5 mil": 5000, "1.000": 1, "2 MIL": 2000, "500 em 30 dias": 500,
    }
    assert apply(spark, lambda c: parse_sales_volume(c, empty_as_zero=True), list(cases)) == list(cases.values())


def test_rating_and_shipping(spark):
    assert apply(spark, parse_rating, ["4.5", "", None, "novo"]) == [4.5, 0.0, 0.0, None]
    texts = ["Entrega GRÁTIS", "Free delivery", "Entrega padrão em 5 dias", "", None]
    assert apply(spark, is_free_shipping, texts) == [True, True, False, False, False]


def test_brand_rules(spark):
    cases = [
        (None, "Smartphone SAMSUNG Galaxy", "Samsung"), ("", "Capa para iphone", "Apple"),
        (None, "Apple Watch", "Apple"), (None, "Maçã Apple", None), (None, "Smartphone Moto G", "Motorola"),
        (None, "Motocicleta", None), (None, "Celular poco X5", "Xiaomi"), (None, "Realme C55", "Realme"),
        (None, "Smartphone Realme C55", None), (None, "LG K62", "LG"), (None, "LGK", None),
        (None, "Smartphone LG K62", "LG"), (None, "Sony Xperia", "Sony"), (None, "Celular ZenFone", "Asus"),
        (None, "Positivo Twist", "Positivo"), ("Nokia", "Samsung Galaxy", "Nokia"), (None, None, None),
        (None, "Samsung com capa de iPhone", "Samsung"),
    ]
    df = spark.createDataFrame([(i, b, t) for i, (b, t, _) in enumerate(cases)], "i int, b string, t string")
    got = df.select("i", brand_from_title(F.col("b"), F.col("t")).alias("o")).orderBy("i").collect()
    assert [r.o for r in got] == [want for *_, want in cases]


def test_condition_and_fallback(spark):
    assert apply(spark, normalize_condition, ["USADO", "used", "Refurbished", "new", "novo", "", None]) == [
        "used", "used", "used", "new", "new", "new", "new"
    ]
    df = spark.createDataFrame(
        [(0, "a", '{"s": "b"}'), (1, "", '{"s": "b"}'), (2, None, '{"t": 1}'), (3, None, "{bad")], "i int, v string, p string"
    )
    got = df.select("i", first_filled(F.col("v"), F.col("p"), "$.s").alias("o")).orderBy("i").collect()
    assert [r.o for r in got] == ["a", "b", None, None]


@pytest.mark.parametrize(
    ("pct", "band"),
    [
        ("0", ("0% (sem desconto)", "0.00", "0.00")), ("0.01", ("1% – 10%", "0.01", "10.00")),
        ("10", ("1% – 10%", "0.01", "10.00")), ("10.005", ("Acima de 50%", "10.01", "20.00")),
        ("20", ("11% – 20%", "10.01", "20.00")), ("30", ("21% – 30%", "20.01", "30.00")),
        ("50", ("31% – 50%", "30.01", "50.00")), ("50.01", ("Acima de 50%", "50.01", "100.00")),
        ("-3", ("Acima de 50%", "0.01", "10.00")), (None, ("Acima de 50%", "50.01", "100.00")),
    ],
)
def test_discount_bands(spark, pct, band):
    df = spark.createDataFrame([(Decimal(pct) if pct else None,)], "p decimal(9,4)")
    row = df.select(*labels.discount_band(F.col("p"))).first()
    assert (row[0], str(row[1]), str(row[2])) == band


def test_price_bands(spark):
    prices = [Decimal(p) for p in ("999.99", "1000", "1999.99", "3499.99", "4999.99", "5000", "0.01")]
    got = apply(spark, labels.price_segment, prices, "decimal(12,2)")
    assert got == [
        "Até R$1.000", "R$1.000 – R$2.000", "R$1.000 – R$2.000", "R$2.000 – R$3.500", "R$3.500 – R$5.000",
        "Acima de R$5.000", "Até R$1.000",
    ]
    assert apply(spark, labels.bucket_start, prices, "decimal(12,2)") == [500, 1000, 1500, 3000, 4500, 5000, 0]
    assert apply(spark, labels.bucket_end, prices, "decimal(12,2)") == [999, 1499, 1999, 3499, 4999, 5499, 499]
    row = spark.sql("select 0 a, 499 b, 1000 c, 1499 d").select(
        labels.bucket_label(F.col("a"), F.col("b")), labels.bucket_label(F.col("c"), F.col("d"))
    ).first()
    assert tuple(row) == ("R$0 – R$499", "R$1.000 – R$1.499")


def test_number_text(spark):
    money = [Decimal("1234567.89"), Decimal("0.50"), None]
    assert apply(spark, labels.brl, money, "decimal(12,2)") == ["R$ 1.234.567,89", "R$ 0,50", "R$ —"]
    values = [12.34, 1234.56, -0.25, None]
    assert apply(spark, labels.pct_text, values, "double") == [
        *[f"{v:.1f}%".replace(".", ",") for v in values[:3]], "—%"
    ]
    assert apply(spark, labels.int_text, [1234.9, 7.0, None], "double") == ["1.234", "7", "—"]


def test_display_texts(spark):
    assert apply(spark, lambda c: labels.shorten(c, 5), ["abcdef", "abcde", None]) == ["abcde...", "abcde", None]
    assert apply(spark, lambda c: labels.display(c, labels.TREND_DISPLAY), ["caiu", "outro"]) == ["↓ Queda", "outro"]
    assert apply(spark, labels.shipping_label, [True, False, None], "boolean") == [
        "com frete grátis", "sem frete grátis", "sem frete grátis"
    ]
    assert apply(spark, labels.trend_label, [1.0, 1.01, -1.0, -1.01, None], "double") == [
        "estável", "subiu", "estável", "caiu", "estável"
    ]


def test_rounding_is_half_away_from_zero(spark):
    assert apply(spark, lambda c: half_up(c, 2), [0.125, -0.125, 2.0], "double") == [0.13, -0.13, 2.0]
    prices = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "p decimal(12,2)")
    assert prices.select(mean(F.col("p"), 2, 2).alias("m")).first().m == Decimal("0.02")
    assert prices.filter("p is null").select(mean(F.col("p"), 2, 2).alias("m")).first().m is None
    row = spark.sql("select 1 a, 8 b, 0 z").select(
        share(F.col("a"), F.col("b"), 1).alias("s"), share(F.col("a"), F.col("z")).alias("n"),
        pct_change(F.lit(672), F.lit(750)).alias("c"), pct_change(F.lit(1), F.lit(0)).alias("x"),
    ).first()
    assert tuple(row) == (Decimal("12.5"), None, Decimal("-10.40"), None)


def test_correlation(spark):
    def r(rows):
        df = spark.createDataFrame(rows, "x double, y double")
        return df.agg(pearson(F.col("x"), F.col("y")).alias("r")).first().r

    assert r([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]) == pytest.approx(1.0)
    assert r([(1.0, 5.0), (2.0, None), (3.0, 1.0), (None, 9.0)]) == pytest.approx(-1.0)
    assert r([(1.0, 2.0), (1.0, 4.0)]) is None
    assert r([(1.0, 2.0)]) is None
    values = [0.6, 0.3, 0.1, 0.0, -0.1, -0.3, -0.6, None]
    assert apply(spark, correlation_strength, values, "double") == [
        "forte positiva", "moderada positiva", "fraca positiva", "fraca negativa", "fraca negativa",
        "moderada negativa", "forte negativa", None,
    ]
