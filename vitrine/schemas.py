"""Record shapes shared by sources, plans and streams."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PERCENT = T.DecimalType(9, 4)
RATING = T.DecimalType(4, 2)

# Defaults of the listing source.
SOURCE_NAME = "amazon_br"
DEFAULT_CURRENCY = "BRL"
CONDITIONS = ["new", "used"]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


LISTING_ITEM = _struct(
    ("asin", T.StringType()),
    ("product_title", T.StringType()),
    ("product_price", T.StringType()),
    ("product_original_price", T.StringType()),
    ("product_star_rating", T.StringType()),
    ("product_num_ratings", T.IntegerType()),
    ("product_url", T.StringType()),
    ("product_photo", T.StringType()),
    ("is_best_seller", T.BooleanType()),
    ("is_amazon_choice", T.BooleanType()),
    ("is_prime", T.BooleanType()),
    ("delivery", T.StringType()),
    ("sales_volume", T.StringType()),
    ("product_num_offers", T.IntegerType()),
    ("currency", T.StringType()),
)

SEARCH_PAGE = _struct(("data", _struct(("products", T.ArrayType(LISTING_ITEM)))))

RECORD = _struct(
    ("ingestion_id", T.StringType()),
    ("batch_id", T.StringType()),
    ("source", T.StringType()),
    ("collected_at", T.TimestampType()),
    ("product_id", T.StringType()),
    ("title", T.StringType()),
    ("brand", T.StringType()),
    ("condition", T.StringType()),
    ("url", T.StringType()),
    ("thumbnail_url", T.StringType()),
    ("price", MONEY),
    ("original_price", MONEY),
    ("discount_pct", PERCENT),
    ("currency", T.StringType()),
    ("rating", RATING),
    ("num_ratings", T.IntegerType()),
    ("is_best_seller", T.BooleanType()),
    ("is_amazon_choice", T.BooleanType()),
    ("is_prime", T.BooleanType()),
    ("free_shipping", T.BooleanType()),
    ("delivery_text", T.StringType()),
    ("sales_volume", T.StringType()),
    ("num_offers", T.IntegerType()),
    ("raw_payload", T.StringType()),
)

REQUIRED_FIELDS = ["ingestion_id", "batch_id", "source", "collected_at"]
KEY = ["product_id", "collected_at"]

RAW = T.StructType(
    RECORD.fields[:4] + [T.StructField("inserted_at", T.TimestampType())] + RECORD.fields[4:]
)

STAGED = T.StructType(RAW.fields + [T.StructField("seed_flag", T.BooleanType())])

FACT_EXTRAS = _struct(
    ("collection_date", T.DateType()),
    ("price_bucket", T.StringType()),
    ("price_bucket_500_start", T.IntegerType()),
    ("price_bucket_500_end", T.IntegerType()),
    ("value_score", T.DecimalType(18, 4)),
)

FACT_COLUMNS = (
    ["ingestion_id", "batch_id", "source", "collected_at", "inserted_at", "collection_date"]
    + ["product_id", "title", "brand", "condition", "url", "thumbnail_url"]
    + ["price", "original_price", "discount_pct", "currency"]
    + ["price_bucket", "price_bucket_500_start", "price_bucket_500_end", "value_score"]
    + ["rating", "num_ratings", "is_best_seller", "is_amazon_choice", "is_prime"]
    + ["free_shipping", "delivery_text", "sales_volume", "num_offers", "seed_flag"]
)

_FACT_FIELDS = {f.name: f for f in STAGED.fields + FACT_EXTRAS.fields}
FACTS = T.StructType([_FACT_FIELDS[name] for name in FACT_COLUMNS])

SEED = T.StructType(
    [f for f in RAW.fields if f.name != "raw_payload"] + [T.StructField("seed_flag", T.BooleanType())]
)

MESSAGE = _struct(
    ("ingestion_id", T.StringType()),
    ("batch_id", T.StringType()),
    ("source", T.StringType()),
    ("collected_at", T.StringType()),
    ("payload", T.StringType()),
)

# As landed: with its place in the stream, which grows in the order of sending.
LANDED = T.StructType([T.StructField("message_id", T.StringType()), *MESSAGE.fields])

DEAD_LETTER = _struct(
    ("original_msg_id", T.StringType()),
    ("ingestion_id", T.StringType()),
    ("product_id", T.StringType()),
    ("batch_id", T.StringType()),
    ("error", T.StringType()),
    ("payload", T.StringType()),
)


def missing_fields(produced: T.StructType, required: T.StructType | list[str]) -> list[str]:
    """Names a consumer needs that a producer does not deliver."""
    names = required if isinstance(required, list) else required.fieldNames()
    return [name for name in names if name not in produced.fieldNames()]
