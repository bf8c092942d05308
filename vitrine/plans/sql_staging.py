"""The two parsing rules as SQL functions and staging as a view by DDL, for users who write SQL only.

Same rules as ``functions.text`` and ``plans.staging``, rendered from the same
fixed values; Catalyst inlines the functions, so they cost what the
expressions cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.functions.text import BRAND_RULES, USED_CONDITIONS
from vitrine.plans.staging import NEUTRAL_VALUES
from vitrine.schemas import SOURCE_NAME, STAGED

_DECIMAL = r"r'(?i)(\d+)[,.](\d+)\s*mil'"
_INTEGER = r"r'(?i)(\d+)\s*mil'"

PARSE_PRICE = r"""(raw STRING) RETURNS DOUBLE
COMMENT 'Brazilian price text: only digits and commas count, the last comma is the decimal mark'
RETURN TRY_CAST(
  replace(regexp_replace(regexp_replace(raw, r'[^0-9,]', ''), r',(?=.*,)', ''), ',', '.') AS DOUBLE)"""

PARSE_SALES_VOLUME = rf"""(volume STRING) RETURNS INT
COMMENT 'Units sold: decimal and mil, integer and mil, all digits, NULL'
RETURN CASE
  WHEN volume RLIKE {_DECIMAL} THEN TRY_CAST(round(TRY_CAST(concat(
    regexp_extract(volume, {_DECIMAL}, 1), '.', regexp_extract(volume, {_DECIMAL}, 2)) AS DECIMAL(28,9)) * 1000, 0) AS INT)
  WHEN volume RLIKE {_INTEGER} THEN
    TRY_CAST(round(TRY_CAST(regexp_extract(volume, {_INTEGER}, 1) AS DECIMAL(28,9)) * 1000, 0) AS INT)
  WHEN volume RLIKE r'\d' THEN TRY_CAST(regexp_replace(volume, r'[^0-9]', '') AS INT)
END"""

FUNCTIONS = {"parse_price_br": PARSE_PRICE, "parse_sales_volume": PARSE_SALES_VOLUME}


def create_functions(spark: SparkSession, database: str | None = None) -> None:
    """The functions for this session, or for good in a database of a catalog that keeps functions."""
    for name, body in FUNCTIONS.items():
        if database is None:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        else:
            spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}{body}")


def _literal(value: str | bool | int) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower()


def _brand() -> str:
    rules = " ".join(
        f"WHEN {' OR '.join(f'title ILIKE {_literal(p)}' for p in patterns)} THEN {_literal(name)}"
        for name, patterns in BRAND_RULES
    )
    return f"coalesce(nullif(brand, ''), CASE {rules} END)"


def _staged_columns() -> dict[str, str]:
    price, original = "CAST(price AS DECIMAL(12,2))", "CAST(original_price AS DECIMAL(12,2))"
    used = ", ".join(_literal(c) for c in USED_CONDITIONS)
    columns = {
        "source": _literal(SOURCE_NAME),
        "brand": _brand(),
        "condition": f"CASE WHEN lower(coalesce(condition, 'new')) IN ({used}) THEN 'used' ELSE 'new' END",
        "price": price,
        "original_price": original,
        "discount_pct": f"CASE WHEN {original} > 0 AND {price} < {original} "
        f"THEN CAST(round(try_divide(({original} - {price}) * 100, {original}), 2) AS DECIMAL(9,4)) "
        "ELSE coalesce(CAST(discount_pct AS DECIMAL(9,4)), CAST(0 AS DECIMAL(9,4))) END",
        "rating": "CAST(rating AS DECIMAL(4,2))",
        "sales_volume": "coalesce(nullif(sales_volume, ''), get_json_object(raw_payload, '$.sales_volume'))",
        "seed_flag": "false",
    }
    return columns | {name: f"coalesce({name}, {_literal(value)})" for name, value in NEUTRAL_VALUES.items()}


def staging_select(raw: str) -> str:
    """Staging as one SELECT over a raw table or view."""
    columns = _staged_columns()
    chosen = ",\n  ".join(f"{columns[n]} AS {n}" if n in columns else n for n in STAGED.fieldNames())
    return f"""WITH copies AS (
  SELECT *, row_number() OVER (PARTITION BY product_id, collected_at
    ORDER BY inserted_at DESC NULLS LAST, ingestion_id DESC NULLS LAST) AS copy
  FROM {raw} WHERE product_id IS NOT NULL)
SELECT {chosen}
FROM copies WHERE copy = 1 AND price > 0"""


def create_staging_view(spark: SparkSession, raw: str, name: str = "stg_products") -> DataFrame:
    """Staging over the raw table or view ``raw`` as a view of the session, which every reader plans into its own query."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {staging_select(raw)}")
    return spark.table(name)
