import json
from decimal import Decimal

from pyspark.sql import functions as F

from vitrine.schemas import DEAD_LETTER, MESSAGE, RECORD
from vitrine.sources import messages as msg

GOOD = {
    "ingestion_id": "m-77", "batch_id": "lote-9", "source": "amazon_br", "collected_at": "2025-02-03T08:15:00+00:00",
    "product_id": "ZX90AZUL01", "title": "Celular", "brand": None, "condition": "new", "url": None,
    "thumbnail_url": None, "price": 845.25, "original_price": 1127.0, "discount_pct": 25.0, "currency": "BRL",
    "rating": 4.1, "num_ratings": 913, "is_best_seller": True, "is_amazon_choice": False, "is_prime": False,
    "free_shipping": True, "delivery_text": "Entrega em 9 dias", "sales_volume": "", "num_offers": 6,
    "raw_payload": {"asin": "ZX90AZUL01", "extra": {"b": [2]}},
}


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


def parsed(spark, payloads):
    rows = [(f"m{i}", "b", "s", "t", p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return msg.parsed(spark.createDataFrame(rows, MESSAGE))


def test_every_cause_is_named(spark):
    cases = [
        (GOOD, None),
        ({**GOOD, "product_id": None}, None),
        ("{bad", msg.MALFORMED), ("[1]", msg.MALFORMED), ("null", msg.MALFORMED), ("7", msg.MALFORMED), ("", msg.MALFORMED),
        ('{"ingestion_id": "x"', msg.MALFORMED),
        (None, "missing field: " + ", ".join(RECORD.fieldNames())),
        (without("price", "title"), "missing field: title, price"),
        ({**GOOD, "collected_at": None, "source": None}, "no value for: source, collected_at"),
        ({**GOOD, "price": "não é número"}, "wrong type for: price"),
        ({**GOOD, "num_ratings": "x", "is_prime": "talvez"}, "wrong type for: num_ratings, is_prime"),
        ({**GOOD, "collected_at": "ontem"}, "wrong type for: collected_at"),
    ]
    df = parsed(spark, [c for c, _ in cases])
    got = {r.ingestion_id: r.error for r in df.collect()}
    assert [got[f"m{i}"] for i in range(len(cases))] == [want for _, want in cases]
    assert tuple(msg.totals(df).first()) == (len(cases), 2, len(cases) - 2)


def test_records_are_typed_and_keep_the_raw_payload(spark):
    row = msg.loadable(parsed(spark, [GOOD])).first()
    assert msg.loadable(parsed(spark, [GOOD])).schema.simpleString() == RECORD.simpleString()
    assert (row.price, row.discount_pct, row.rating) == (Decimal("845.25"), Decimal("25.0000"), Decimal("4.10"))
    assert row.collected_at.isoformat() == "2025-02-03T08:15:00"
    assert json.loads(row.raw_payload) == GOOD["raw_payload"]


def test_dead_letters_recover_the_product(spark):
    df = parsed(spark, [{**GOOD, "price": "x"}, "{bad", None])
    letters = msg.dead_letters(df, F.col("ingestion_id"))
    assert letters.columns == DEAD_LETTER.fieldNames()
    got = {r.original_msg_id: (r.product_id, r.payload) for r in letters.collect()}
    assert got["m0"][0] == "ZX90AZUL01"
    assert got["m1"] == ("unknown", "{bad") and got["m2"] == ("unknown", "{}")


def test_envelope_round_trip(spark):
    sent = msg.envelope(msg.loadable(parsed(spark, [GOOD, {**GOOD, "product_id": None}])))
    assert sent.columns == MESSAGE.fieldNames()
    assert all(f.dataType.simpleString() == "string" for f in sent.schema)
    back = msg.loadable(msg.parsed(sent)).collect()
    assert {str(r.product_id) for r in back} == {"ZX90AZUL01", "None"} and len(back) == 2
    assert all(r.price == Decimal("845.25") and r.brand is None for r in back)


def test_publish_failures(spark):
    records = msg.loadable(parsed(spark, [GOOD, {**GOOD, "product_id": None}]))
    letters = msg.publish_failures(records, F.lit("broker down"))
    assert letters.columns == DEAD_LETTER.fieldNames()
    assert sorted((r.product_id, r.error, r.payload) for r in letters.collect()) == [
        ("ZX90AZUL01", "broker down", None), ("unknown", "broker down", None)
    ]
