"""Registered queries by SQL functions, the staging view and mergeable sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.catalog.parsing import ORACLES as PARSED
from vitrine.catalog.sql import OBS, STAGED, money, quantile, volume_units
from vitrine.functions.numeric import cents
from vitrine.operators.percentiles import exact_percentiles
from vitrine.operators.sketches import daily_sketches, distinct_estimate, merged_sketches, quantile_estimate
from vitrine.plans.sql_staging import create_functions, create_staging_view
from vitrine.session import scratch_folder
from vitrine.sources import sales_tables as st
from vitrine.sources.tables import materialise_table

QUARTILES = {"p25_price": 0.25, "median_price": 0.5, "p75_price": 0.75}


def staged_by_view(spark: SparkSession, folder: str) -> DataFrame:
    """The staging set by the SQL view, with the units sold by the SQL function."""
    create_functions(spark)
    st.raw_products(spark, folder).createOrReplaceTempView("raw_products")
    create_staging_view(spark, "raw_products", "stg_products")
    return spark.sql("SELECT *, parse_sales_volume(sales_volume) AS units FROM stg_products")


def parse_price_by_sql(spark: SparkSession, folder: str) -> DataFrame:
    create_functions(spark)
    lines = st.observed_lines(spark, folder).select("l_linenumber", st.price_text().alias("price_text"))
    lines.createOrReplaceTempView("priced_lines")
    return spark.sql(
        """WITH parsed AS (SELECT l_linenumber, parse_price_br(price_text) AS price FROM priced_lines)
        SELECT l_linenumber, count(*) AS n, count(price) AS n_parsed, sum(floor(price * 100 + 0.5)) AS price_cents,
          min(price) AS min_price, max(price) AS max_price
        FROM parsed GROUP BY l_linenumber"""
    )


def _days(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Observations, and their sketches per day as stored."""
    rows = st.observations(spark, folder, "product_id", "collected_at", "price").select(
        "product_id", F.to_date("collected_at").alias("day"), cents(F.col("price")).alias("cents")
    )
    daily = daily_sketches(rows, F.col("day"), F.col("product_id"), F.col("cents"))
    return rows, materialise_table(daily, f"{scratch_folder(spark, 'sketches')}/daily")


def _periods(day: str):
    """The periods a day is in: its month, its year, and all time."""
    return F.explode(F.array(F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy"), F.lit("all")))


def distinct_by_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct products of every month, every year and all time: exact, and whether the merged sketches are within 2 %."""
    rows, daily = _days(spark, folder)
    merged = merged_sketches(daily.withColumn("period", _periods("day")), F.col("period"))
    guessed = merged.select("period", "n", distinct_estimate(F.col("distinct_sketch")).alias("guess"))
    # a product is counted once a month at first, so that no row is there three times
    months = rows.groupBy("product_id", F.trunc("day", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    exact = (
        months.select("product_id", _periods("month").alias("period"))
        .distinct()
        .groupBy("period")
        .agg(F.count("product_id").alias("products"))
    )
    near = F.abs(F.col("guess") - F.col("products")) <= F.col("products") * 0.02
    return exact.join(guessed, "period").select("period", "n", "products", near.alias("within"))


def quantiles_by_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of every year's prices: exact, and whether each merged sketch's value has its rank within 1 %."""
    rows, daily = _days(spark, folder)
    rows = rows.select(F.year("day").alias("period"), "cents")
    merged = merged_sketches(daily, F.year("day"))
    guessed = merged.select(
        "period", *(quantile_estimate(F.col("value_sketch"), q).alias(f"guess_{name}") for name, q in QUARTILES.items())
    )
    # one row a year: Spark sees the size and sends it to all tasks
    ranked = rows.join(guessed, "period").groupBy("period").agg(
        F.count("cents").alias("n"),
        *(F.count_if(F.col("cents") < F.col(f"guess_{name}")).alias(f"below_{name}") for name in QUARTILES),
        *(F.count_if(F.col("cents") <= F.col(f"guess_{name}")).alias(f"upto_{name}") for name in QUARTILES),
    )
    within = F.lit(True)
    for name, q in QUARTILES.items():
        within &= F.lit(q).between(F.col(f"below_{name}") / F.col("n") - 0.01, F.col(f"upto_{name}") / F.col("n") + 0.01)
    exact = exact_percentiles(rows, ["period"], F.col("cents"), QUARTILES)
    return exact.join(ranked, "period").select(
        "period", "n", *((F.floor(F.col(name) + 0.5) / 100).alias(name) for name in QUARTILES), within.alias("within")
    )


QUERIES = {f.__name__: f for f in [staged_by_view, parse_price_by_sql, distinct_by_sketch, quantiles_by_sketch]}

ORACLES = {
    "staged_by_view": f"""
with {STAGED}
select * exclude (cents, original_cents, rating2), {money('cents')} as price, {money('original_cents')} as original_price,
  rating2::double / 2 as rating, {volume_units('sales_volume')} as units
from stg""",
    "parse_price_by_sql": PARSED["parse_price_br"],
    "distinct_by_sketch": f"""
with {OBS}, p as (
  select product_id, unnest([strftime(collected_at, '%Y-%m'), strftime(collected_at, '%Y'), 'all']) as period from obs)
select period, count(*) as n, count(distinct product_id) as products, true as within from p group by 1""",
    "quantiles_by_sketch": f"""
with {OBS}
select cast(year(collected_at) as int) as period, count(*) as n, {quantile(0.25)} as p25_price,
  {quantile(0.5)} as median_price, {quantile(0.75)} as p75_price, true as within
from obs group by 1""",
}
