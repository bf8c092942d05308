"""Search pages of listings to product records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.text import is_free_shipping, parse_price, parse_rating
from vitrine.schemas import DEFAULT_CURRENCY, MONEY, PERCENT, RATING, RECORD, SEARCH_PAGE, SOURCE_NAME

# Shares that a batch's pages are joined in.
SALTS = 16


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search pages, one JSON document per file."""
    return spark.read.schema(SEARCH_PAGE).option("multiLine", True).json(path)


def page_items(pages: DataFrame) -> DataFrame:
    """One row per listed product; pages without products give none."""
    return pages.select(*[c for c in pages.columns if c != "data"], F.explode("data.products").alias("item"))


def pages_until_empty(
    pages: DataFrame, batch: str, page: str, is_empty: Column, max_pages: int | None = None
) -> DataFrame:
    """Pages of each batch before its first empty one, up to ``max_pages``.

    The cut is one row per batch from a partial aggregate.  It is repeated for
    each of SALTS shares of a batch's pages, so that the join deals a heavy
    batch out to as many tasks.
    """
    numbered = pages if max_pages is None else pages.filter(F.col(page) <= max_pages)
    cuts = numbered.filter(is_empty).groupBy(batch).agg(F.min(page).alias("_first_empty"))
    salted = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        numbered.withColumn("_salt", F.pmod(F.hash(page), F.lit(SALTS)))
        .join(salted, [batch, "_salt"], "left")
        .filter(F.col("_first_empty").isNull() | (F.col(page) < F.col("_first_empty")))
        .select(*pages.columns)
    )


def batch_stamp(instant: Column) -> Column:
    """Collection batch of an instant: ``batch-2026-04-03-10h``."""
    hour = F.translate(F.substring(instant.cast("string"), 1, 13), " ", "-")
    return F.concat(F.lit("batch-"), hour, F.lit("h"))


def collection_discount(price: Column, original: Column) -> Column:
    """Discount as seen at collection; negative when the price went up, 0 when unknown."""
    known = (original > 0) & (price != 0)
    pct = F.round(F.try_divide((original - price) * F.lit(100), original), 2)
    return F.when(known, pct).otherwise(F.lit(0)).cast(PERCENT)


def records(items: DataFrame, collected_at: Column, ingestion_id: Column | None = None) -> DataFrame:
    """Normalises listing items (column ``item``) to the 24-field record."""
    price = parse_price(F.col("item.product_price")).try_cast(MONEY)
    original = parse_price(F.col("item.product_original_price")).try_cast(MONEY)

    def known(name: str, default: object) -> Column:
        return F.coalesce(F.col(f"item.{name}"), F.lit(default))

    columns = {
        "ingestion_id": F.uuid() if ingestion_id is None else ingestion_id,
        "batch_id": batch_stamp(collected_at),
        "source": F.lit(SOURCE_NAME),
        "collected_at": collected_at,
        "product_id": F.col("item.asin"),
        "title": F.col("item.product_title"),
        "brand": F.lit(None).cast("string"),
        "condition": F.lit("new"),
        "url": F.col("item.product_url"),
        "thumbnail_url": F.col("item.product_photo"),
        "price": price,
        "original_price": original,
        "discount_pct": collection_discount(price, original),
        "currency": known("currency", DEFAULT_CURRENCY),
        "rating": parse_rating(F.col("item.product_star_rating")).try_cast(RATING),
        "num_ratings": known("product_num_ratings", 0),
        "is_best_seller": known("is_best_seller", False),
        "is_amazon_choice": known("is_amazon_choice", False),
        "is_prime": known("is_prime", False),
        "free_shipping": is_free_shipping(F.col("item.delivery")),
        "delivery_text": known("delivery", ""),
        "sales_volume": known("sales_volume", ""),
        "num_offers": known("product_num_offers", 0),
        "raw_payload": F.to_json("item"),
    }
    return items.select(*[columns[name].alias(name) for name in RECORD.fieldNames()])
