"""What the plans of registered queries do and don't contain."""

import pytest

from vitrine.catalog import queries


def plan(spark, small, name):
    return queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString().splitlines()


def nodes(lines, word):
    return [line for line in lines if word in line]


def test_price_variation_hashes_the_rows(spark, small):
    lines = plan(spark, small, "price_variation")
    assert len(nodes(lines, "HashAggregate(keys=[product_id")) == 2
    # only the groups by title and brand are sorted
    first_sort = max(n for n, line in enumerate(lines) if "SortAggregate" in line)
    assert first_sort < min(n for n, line in enumerate(lines) if "HashAggregate(keys=[product_id" in line)


@pytest.mark.parametrize(("name", "key"), [("free_shipping_mix", "condition"), ("discount_buckets", "discount_bucket")])
def test_sub_totals_expand_groups_not_rows(spark, small, name, key):
    lines = plan(spark, small, name)
    expand = next(n for n, line in enumerate(lines) if "Expand" in line)
    assert any(f"HashAggregate(keys=[{key}" in line for line in lines[expand + 1 :])


def test_overview_expands_nothing(spark, small):
    assert not nodes(plan(spark, small, "market_overview"), "Expand")


def test_payloads_are_parsed_once(spark, small):
    assert len(nodes(plan(spark, small, "dead_letter_split"), "from_json")) == 1


@pytest.mark.parametrize("name", ["incremental_upsert"])
def test_no_join_that_cannot_match(spark, small, name):
    assert not nodes(plan(spark, small, name), "LeftAnti")


def test_a_heavy_batch_is_dealt_out(spark):
    from pyspark.sql import functions as F

    from vitrine.sources.listings import SALTS, pages_until_empty

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = spark.range(20_000).selectExpr("CAST(id * 0 AS STRING) AS batch", "CAST(id AS INT) AS page", "id = 19000 AS empty")
        kept = pages_until_empty(pages, "batch", "page", F.col("empty"))
        assert kept.count() == 19_000
        joins = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
        assert joins and all("_salt" in line for line in joins)
        shares = pages.select(F.pmod(F.hash("page"), F.lit(SALTS)).alias("s")).groupBy("s").count().collect()
        assert len(shares) == SALTS and max(r["count"] for r in shares) < 2 * 20_000 / SALTS
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
