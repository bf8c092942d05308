"""Registered queries for the quality rules, run on raw rows so that they find something."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.catalog.marts import brand_dimension
from vitrine.catalog.sql import RAW, STAGED, money
from vitrine.operators import quality as q
from vitrine.plans.facts import facts
from vitrine.plans.staging import staged
from vitrine.schemas import CONDITIONS, KEY, SOURCE_NAME
from vitrine.sources.sales_tables import raw_products


def dq_discount_range(spark: SparkSession, folder: str) -> DataFrame:
    return q.discount_out_of_range(raw_products(spark, folder)).select(
        "product_id", "title", "price", "original_price", "discount_pct", "collected_at"
    )


def dq_price_positive(spark: SparkSession, folder: str) -> DataFrame:
    return q.price_not_positive(raw_products(spark, folder)).select(
        "product_id", "title", "price", "collected_at", "source"
    )


def dq_quantity_nonnegative(spark: SparkSession, folder: str) -> DataFrame:
    return q.quantity_negative(raw_products(spark, folder)).select("product_id", "title", "num_ratings", "collected_at")


def dq_valid_condition(spark: SparkSession, folder: str) -> DataFrame:
    rows = q.unaccepted_values(raw_products(spark, folder), "condition", CONDITIONS, null_fails=True)
    return rows.select("product_id", "title", "condition", "collected_at")


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return q.null_counts(raw_products(spark, folder), q.STAGED_NOT_NULL)


def dq_unique_key(spark: SparkSession, folder: str) -> DataFrame:
    return q.repeated_keys(raw_products(spark, folder), KEY)


def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = q.unaccepted_values(raw_products(spark, folder), "source", [SOURCE_NAME])
    return rows.select("ingestion_id", "source")


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """All 25 rules: the staging rules on raw rows, the others on the cleaned layers."""
    raw = raw_products(spark, folder)
    fact = facts(staged(raw))
    return q.rule_report(raw, fact, brand_dimension(spark, folder))


def dq_run_status(spark: SparkSession, folder: str) -> DataFrame:
    return q.run_status(q.rule_report(raw_products(spark, folder)))


QUERIES = {
    f.__name__: f
    for f in [
        dq_discount_range, dq_price_positive, dq_quantity_nonnegative, dq_valid_condition, dq_not_null,
        dq_unique_key, dq_accepted_values, dq_report, dq_run_status,
    ]
}

_KNOWN = {c: ("cents" if c == "price" else c) for c in q.STAGED_NOT_NULL}
_NULLS = "\nunion all\n".join(
    f"select '{name}' as \"column\", count(*) filter ({sql} is null) as failures from raw"
    for name, sql in _KNOWN.items()
)
_RULES = {
    **{f"staged.{c}.not_null": f"count(*) filter ({sql} is null) from raw" for c, sql in _KNOWN.items()},
    "staged.source.accepted_values": "count(*) filter (source <> 'amazon_br') from raw",
    "staged.condition.accepted_values": "count(*) filter (condition not in ('new', 'used')) from raw",
    "discount_range": "count(*) filter (discount_pct < 0 or discount_pct > 100) from raw",
    "price_positive": "count(*) filter (cents is null or cents <= 0) from raw",
    "quantity_nonnegative": "count(*) filter (num_ratings < 0) from raw",
    "valid_condition": "count(*) filter (condition is null or condition not in ('new', 'used')) from raw",
    "staged.ingestion_id.unique": "count(*) from (select 1 from raw group by ingestion_id having count(*) > 1)",
    "staged.product_collected.unique": """count(*) from (
      select 1 from raw where product_id is not null group by product_id, collected_at having count(*) > 1)""",
    **{
        f"facts.{c}.not_null": f"count(*) filter ({'cents' if c == 'price' else c} is null) from stg"
        for c in q.FACT_NOT_NULL
    },
    "facts.product_collected.unique": """count(*) from (
      select 1 from stg group by product_id, collected_at having count(*) > 1)""",
    "brands.brand.not_null": "0 from (select 1)",
    "brands.brand.unique": "0 from (select 1)",
}
_ALL_RULES = "\nunion all\n".join(f"select '{name}' as rule, {sql}" for name, sql in _RULES.items())

ORACLES = {
    "dq_discount_range": f"""
with {RAW}
select product_id, title, {money('cents')} as price, {money('original_cents')} as original_price,
  discount_pct::double as discount_pct, collected_at
from raw where discount_pct < 0 or discount_pct > 100""",
    "dq_price_positive": f"""
with {RAW}
select product_id, title, {money('cents')} as price, collected_at, source from raw where cents is null or cents <= 0""",
    "dq_quantity_nonnegative": f"""
with {RAW} select product_id, title, num_ratings, collected_at from raw where num_ratings < 0""",
    "dq_valid_condition": f"""
with {RAW}
select product_id, title, condition, collected_at from raw where condition is null or condition not in ('new', 'used')""",
    "dq_not_null": f"with {RAW}\n{_NULLS}",
    "dq_unique_key": f"""
with {RAW}
select product_id, collected_at, count(*) as n from raw
where product_id is not null and collected_at is not null group by 1, 2 having count(*) > 1""",
    "dq_accepted_values": f"with {RAW} select ingestion_id, source from raw where source <> 'amazon_br'",
    "dq_report": f"""
with {STAGED}
select rule, failures, case when failures = 0 then 'pass' else 'fail' end as status
from ({_ALL_RULES}) r(rule, failures)""",
    "dq_run_status": f"""
with {RAW}
select case when count(*) filter (cents is null or discount_pct < 0) > 0 then 'PARTIAL' else 'COMPLETED' end
    as run_status
from raw""",
}
