import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from vitrine.schemas import LISTING_ITEM, RECORD, missing_fields
from vitrine.sources.listings import batch_stamp, page_items, pages_until_empty, read_pages, records

FULL = {
    "asin": "ZX90AZUL01", "product_title": "Celular Aurora Z9 256GB Azul", "product_price": "R$ 845,25",
    "product_original_price": "R$ 1.127,00", "product_star_rating": "4.1", "product_num_ratings": 913,
    "product_url": "https://example.com/1", "product_photo": "https://example.com/1.jpg", "is_best_seller": True,
    "is_amazon_choice": False, "is_prime": False, "delivery": "Entrega em 9 dias", "currency": "BRL",
    "sales_volume": "Mais de 900 compras no mês passado", "product_num_offers": 6, "unknown_key": {"b": 2},
}
NO_ORIGINAL = {**FULL, "asin": "ZX90AZUL02", "product_original_price": None, "product_star_rating": "sem nota"}
FREE = {**FULL, "asin": "ZX90AZUL03", "product_price": "R$ 2.350,10", "delivery": "Entrega GRÁTIS"}
BARE = {"asin": "ZX90AZUL04", "product_title": "x"}
RAISED = {**FULL, "asin": "ZX90AZUL05", "product_original_price": "R$ 700,00"}


def normalised(spark, folder, pages):
    for n, page in enumerate(pages):
        with open(os.path.join(folder, f"page{n}.json"), "w", encoding="utf-8") as out:
            json.dump(page, out, indent=1, ensure_ascii=False)
    items = page_items(read_pages(spark, folder))
    rows = records(items, F.lit("2025-08-17 14:20:00").cast("timestamp"))
    return rows, {r.product_id: r for r in rows.collect()}


def test_pages_to_records(spark, folder):
    pages = [{"data": {"products": [FULL, NO_ORIGINAL, FREE]}}, {"data": {"products": [BARE, RAISED]}},
             {"data": {"products": []}}, {"data": {}}, {"status": "OK"}]
    df, got = normalised(spark, folder, pages)
    assert len(got) == 5
    assert df.schema.fieldNames() == RECORD.fieldNames()
    full = got["ZX90AZUL01"]
    assert (full.price, full.original_price, full.discount_pct) == (Decimal("845.25"), Decimal("1127.00"), Decimal("25.00"))
    assert (full.batch_id, full.source, full.condition, full.brand) == ("batch-2025-08-17-14h", "amazon_br", "new", None)
    assert full.free_shipping is False and full.is_best_seller is True
    assert json.loads(full.raw_payload)["sales_volume"] == FULL["sales_volume"]
    assert got["ZX90AZUL02"].discount_pct == 0 and got["ZX90AZUL02"].rating is None
    assert got["ZX90AZUL03"].free_shipping is True and got["ZX90AZUL03"].price == Decimal("2350.10")
    bare = got["ZX90AZUL04"]
    assert (bare.price, bare.discount_pct, bare.rating, bare.num_ratings, bare.num_offers) == (None, 0, 0, 0, 0)
    assert (bare.currency, bare.is_prime, bare.delivery_text, bare.sales_volume) == ("BRL", False, "", "")
    assert got["ZX90AZUL05"].discount_pct == Decimal("-20.75")
    assert len({r.ingestion_id for r in got.values()}) == 5


def test_records_deliver_what_the_raw_table_needs():
    assert missing_fields(RECORD, RECORD) == []
    assert missing_fields(LISTING_ITEM, ["asin", "price"]) == ["price"]


def pages(spark, sizes):
    rows = [(batch, page, size) for batch, counts in sizes.items() for page, size in enumerate(counts, 1)]
    return spark.createDataFrame(rows, "batch string, page int, size int")


def test_paging_stops_at_the_first_empty_page(spark):
    df = pages(spark, {"a": [0, 3], "b": [2, 2, 0, 5], "c": [1, 1, 1]})
    kept = pages_until_empty(df, "batch", "page", F.col("size") == 0)
    assert sorted((r.batch, r.page) for r in kept.collect()) == [("b", 1), ("b", 2), ("c", 1), ("c", 2), ("c", 3)]
    capped = pages_until_empty(df, "batch", "page", F.col("size") == 0, max_pages=2)
    assert sorted((r.batch, r.page) for r in capped.collect()) == [("b", 1), ("b", 2), ("c", 1), ("c", 2)]


def test_batch_stamp(spark):
    row = spark.sql("select timestamp '2025-08-17 23:59:59' t").select(batch_stamp(F.col("t")).alias("b")).first()
    assert row.b == "batch-2025-08-17-23h"
