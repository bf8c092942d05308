"""Product listings derived from the sales tables ``lineitem`` and ``part``.

The registered queries run on these tables, which hold order lines instead of
listings.  Every line becomes one observation of its part on its ship date;
amounts are derived in whole cents.  ``part`` is joined only when one of its
attributes is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import first_case
from vitrine.functions.labels import bucket_end, bucket_start, grouped_int, price_segment
from vitrine.functions.numeric import from_units
from vitrine.operators.partitioning import as_asked
from vitrine.plans.facts import value_score
from vitrine.schemas import MONEY, PERCENT, RATING, SOURCE_NAME
from vitrine.sources.listings import batch_stamp

HISTORY_END = "1996-01-01"

# Title beginnings: one or two per brand rule, then two that match none.
TITLE_STARTS = [
    "Smartphone Samsung Galaxy ", "Capa para iPhone ", "Apple ", "Motorola ", "Smartphone Moto G ", "Xiaomi ",
    "Celular REDMI ", "Smartphone poco ", "Realme ", "LG ", "Smartphone LG ", "Sony ", "Celular Zenfone ",
    "Positivo ", "Smartphone Realme ", "Celular ",
]

_CENTS = "cast(floor(l_extendedprice * 100 + 0.5) as bigint) div cast(l_quantity as bigint)"
_PCT = "6 * cast(floor(l_discount * 100 + 0.5) as bigint)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def observed_lines(spark: SparkSession, folder: str, textual: bool = True) -> DataFrame:
    """Lines with their amounts; dealt out on request when text is to be built from them."""
    lines = table(spark, folder, "lineitem")
    return _with_amounts(as_asked(lines) if textual else lines)


def _with_amounts(lines: DataFrame) -> DataFrame:
    return lines.withColumns({"cents": F.expr(_CENTS), "pct": F.expr(_PCT)})


def from_lines(lines: DataFrame, *columns: str) -> DataFrame:
    """Observation columns that need no part attribute, of a batch or a stream of lines."""
    return _with_amounts(lines).select(*[_FROM_LINE[name]().alias(name) for name in columns])


def _with_part(lines: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey"))


def _money(amount_in_cents: Column) -> Column:
    return from_units(amount_in_cents, 2).cast(MONEY)


def _original_cents() -> Column:
    return F.expr("cents * 100 div (100 - pct)")


def _ingestion_id() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").cast("string")
    )


def _volume_text() -> Column:
    units = F.col("l_quantity").cast("int")
    step = F.col("l_linenumber") % 4
    return (
        F.when(step == 0, "")
        .when(step == 1, F.concat(F.lit("Mais de "), units, F.lit(" compras no mês passado")))
        .when(step == 2, F.concat(F.lit("Mais de "), units, F.lit(" mil compras no mês passado")))
        .otherwise(
            F.concat(
                F.lit("Mais de "), F.floor(units / 10), F.lit(","), units % 10, F.lit(" mil compras no mês passado")
            )
        )
    )


_FROM_LINE = {
    "ingestion_id": _ingestion_id,
    "collected_at": lambda: F.col("l_shipdate"),
    "product_id": lambda: F.col("l_partkey").cast("string"),
    "condition": lambda: F.when(F.col("l_returnflag") == "R", "used").otherwise("new"),
    "price": lambda: _money(F.col("cents")),
    "original_price": lambda: _money(_original_cents()),
    "discount_pct": lambda: F.col("pct").cast(PERCENT),
    "num_ratings": lambda: F.col("l_quantity").cast("int"),
    "is_best_seller": lambda: F.col("l_quantity") >= 45,
    "is_amazon_choice": lambda: F.col("l_tax") == 0,
    "is_prime": lambda: F.col("l_linenumber") <= 3,
    "free_shipping": lambda: F.col("l_linestatus") == "O",
    "sales_volume": _volume_text,
    "seed_flag": lambda: F.col("l_shipdate") < F.lit(HISTORY_END).cast("timestamp_ntz"),
}
_FROM_PART = {
    "title": lambda: F.col("p_name"),
    "brand": lambda: F.nullif(F.col("p_brand"), F.lit("Brand#7")),
    "rating": lambda: (F.col("p_size") % 11 / 2).cast(RATING),
}
_ALL = {**_FROM_LINE, **_FROM_PART}


def observations(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Clean observations, live and history together; all columns unless some are named."""
    names = columns or tuple(_ALL)
    lines = observed_lines(spark, folder, textual="sales_volume" in names)
    if any(name in _FROM_PART for name in names):
        lines = _with_part(lines, spark, folder)
    return lines.select(*[_ALL[name]().alias(name) for name in names])


def live_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Real observations with the derived columns of the fact set."""
    price = F.col("price")
    return (
        observations(spark, folder)
        .filter(~F.col("seed_flag"))
        .withColumns(
            {
                "collection_date": F.to_date("collected_at"),
                "price_bucket": price_segment(price),
                "price_bucket_500_start": bucket_start(price),
                "price_bucket_500_end": bucket_end(price),
                "value_score": value_score(F.col("rating"), F.col("num_ratings"), price),
            }
        )
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows as they arrive: repeated keys, gaps, zero prices, odd spellings, wrong discounts."""
    line, pct = F.col("l_linenumber"), F.col("pct")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    start = F.element_at(
        F.array(*[F.lit(t) for t in TITLE_STARTS]), (F.col("l_partkey") % len(TITLE_STARTS) + 1).cast("int")
    )
    quantity = F.col("l_quantity").cast("int")
    raised = F.expr("cents * 9 div 10")
    price = _money(F.col("cents"))
    missing = F.lit(None)
    columns = {
        "ingestion_id": _ingestion_id(),
        "batch_id": batch_stamp(F.col("l_shipdate")),
        "source": F.when((line == 6) & (F.col("l_tax") == 0), "outra_fonte").otherwise(SOURCE_NAME),
        "collected_at": F.col("l_shipdate"),
        "inserted_at": F.expr("l_shipdate + make_dt_interval(0, l_linenumber)"),
        "product_id": F.when((line == 7) & (status == "F") & (quantity <= 5), missing).otherwise(
            F.col("l_partkey").cast("string")
        ),
        "title": F.concat(start, "p_name"),
        "brand": F.when(flag == "R", F.col("p_brand")).when(flag == "A", F.lit("")),
        "condition": F.when(flag == "R", "Refurbished").when(flag == "A", "new"),
        "url": F.concat(F.lit("https://example.com/dp/"), "l_partkey"),
        "thumbnail_url": F.concat(F.lit("https://example.com/thumb/"), "l_partkey", F.lit(".jpg")),
        "price": F.when((line == 7) & (pct == 0), missing).when((line == 7) & (pct == 6), 0).otherwise(price).cast(MONEY),
        "original_price": F.when(pct == 0, _money(raised)).when(pct == 6, missing).otherwise(_money(_original_cents())),
        "discount_pct": F.when(pct == 0, F.round((_money(raised) - price) * 100 / _money(raised), 2))
        .when(pct == 6, missing)
        .when(pct == 12, 0)
        .otherwise(pct)
        .cast(PERCENT),
        "currency": F.when(flag != "N", "BRL"),
        "rating": (F.col("p_size") % 11 / 2).cast(RATING),
        "num_ratings": F.when(quantity >= 48, missing).when(quantity == 1, -1).otherwise(quantity),
        "is_best_seller": F.when(flag != "N", quantity >= 45),
        "is_amazon_choice": F.when(line != 3, F.col("l_tax") == 0),
        "is_prime": F.when(line != 2, line <= 3),
        "free_shipping": F.when(line != 1, status == "O"),
        "delivery_text": F.when(line != 2, F.when(status == "O", "Entrega GRÁTIS").otherwise("Entrega padrão em 5 dias")),
        "sales_volume": F.when(line == 5, missing).otherwise(_volume_text()),
        "num_offers": F.when(line != 4, line),
        "raw_payload": F.concat(F.lit('{"sales_volume": "'), quantity, F.lit(' compras"}')),
    }
    return _with_part(observed_lines(spark, folder), spark, folder).select(*[c.alias(n) for n, c in columns.items()])


def price_text() -> Column:
    """Prices as shops write them, by line number; some are no prices at all."""
    whole = F.expr("cents div 100")
    fraction = F.lpad((F.col("cents") % 100).cast("string"), 2, "0")
    dotted = F.concat(grouped_int(whole), F.lit(","), fraction)
    line = F.col("l_linenumber")
    return first_case(
        [
            (line == 1, F.concat(F.lit("R$ "), dotted)),
            (line == 2, F.concat(whole.cast("string"), F.lit(","), fraction)),
            (line == 3, F.concat(F.lit("R$"), dotted, F.lit(" à vista"))),
            (line == 4, F.lit("")),
            (line == 5, F.lit("indisponível")),
            (line == 6, F.concat(F.format_number(whole, 0), F.lit(","), fraction)),
        ]
    )


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Search pages as JSON text, one listed product each, with ``collected_at``."""
    original = F.expr("cents * 100 div (100 - pct)")
    item = {
        "asin": F.col("l_partkey").cast("string"),
        "product_title": F.col("p_name"),
        "product_price": price_text(),
        "product_original_price": F.when(
            F.col("pct") > 0,
            F.concat(
                F.lit("R$ "), grouped_int(F.floor(original / 100)), F.lit(","),
                F.lpad((original % 100).cast("string"), 2, "0"),
            ),
        ),
        "product_star_rating": F.when(F.col("l_returnflag") == "R", "novo").when(
            F.col("l_returnflag") == "A", (F.col("p_size") % 11 / 2).cast("string")
        ),
        "product_num_ratings": F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("int")),
        "product_url": F.concat(F.lit("https://example.com/dp/"), "l_partkey"),
        "product_photo": F.concat(F.lit("https://example.com/thumb/"), "l_partkey", F.lit(".jpg")),
        "is_best_seller": F.when(F.col("l_returnflag") != "N", F.col("l_quantity") >= 45),
        "is_prime": F.col("l_linenumber") <= 3,
        "delivery": delivery_text(),
        "sales_volume": _volume_text(),
        "product_num_offers": F.when(F.col("l_linenumber") != 4, F.col("l_linenumber")),
        "currency": F.when(F.col("l_returnflag") != "N", "BRL"),
    }
    product = F.struct(*[c.alias(n) for n, c in item.items()])
    page = F.to_json(F.struct(F.struct(F.array(product).alias("products")).alias("data")))
    lines = _with_part(observed_lines(spark, folder), spark, folder)
    return lines.select(F.col("l_shipdate").alias("collected_at"), _ingestion_id().alias("ingestion_id"), page.alias("page"))


def delivery_text() -> Column:
    line = F.col("l_linenumber")
    return first_case(
        [
            (line == 1, "Entrega GRÁTIS: amanhã"),
            (line == 2, "Entrega grátis em 2 dias"),
            (line == 3, "FREE delivery"),
            (line == 4, ""),
            (line == 5, "Entrega padrão em 5 dias"),
            (line == 6, "Retirada na loja"),
        ]
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Stream messages built from events; their type decides what is wrong with them.

    Works on a batch and on a streaming read of the events table.
    """
    kind = F.col("event_type")
    shipped = F.date_trunc("hour", "ts")
    record = F.struct(
        F.col("event_id").cast("string").alias("ingestion_id"),
        F.when(kind != "signup", batch_stamp(F.col("ts"))).alias("batch_id"),
        F.lit(SOURCE_NAME).alias("source"),
        F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"),
        F.col("user_id").cast("string").alias("product_id"),
        F.concat(F.lit("Produto "), "user_id").alias("title"),
        F.lit(None).cast("string").alias("brand"),
        F.lit("new").alias("condition"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("thumbnail_url"),
        F.when(kind == "click", F.lit("n/d")).otherwise(F.col("value").cast(MONEY).cast("string")).alias("price"),
        F.lit(None).cast("string").alias("original_price"),
        F.lit("0").alias("discount_pct"),
        F.lit("BRL").alias("currency"),
        F.lit("4.5").alias("rating"),
        F.get_json_object("props", "$.k").cast("int").alias("num_ratings"),
        F.lit(False).alias("is_best_seller"),
        F.lit(False).alias("is_amazon_choice"),
        F.lit(False).alias("is_prime"),
        F.lit(False).alias("free_shipping"),
        F.lit("").alias("delivery_text"),
        F.lit("").alias("sales_volume"),
        F.lit(0).alias("num_offers"),
        F.col("props").alias("raw_payload"),
    )
    whole = F.to_json(record, {"ignoreNullFields": "false"})
    return events.select(
        F.col("event_id").cast("string").alias("ingestion_id"),
        batch_stamp(F.col("ts")).alias("batch_id"),
        F.lit(SOURCE_NAME).alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("collected_at"),
        F.when(kind == "error", F.expr("substring(props, 1, length(props) - 1)"))
        .otherwise(whole)
        .alias("payload"),
    )
