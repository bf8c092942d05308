"""Data-quality rules: each is a query for offending rows, and passes when it is empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.schemas import CONDITIONS, KEY, SOURCE_NAME

STAGED_NOT_NULL = [
    "ingestion_id", "batch_id", "source", "collected_at", "inserted_at",
    "product_id", "title", "condition", "price",
]
FACT_NOT_NULL = ["ingestion_id", "batch_id", "collected_at", "product_id", "price"]


def discount_out_of_range(df: DataFrame) -> DataFrame:
    return df.filter((F.col("discount_pct") < 0) | (F.col("discount_pct") > 100))


def price_not_positive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("price").isNull() | (F.col("price") <= 0))


def quantity_negative(df: DataFrame) -> DataFrame:
    return df.filter(F.col("num_ratings") < 0)


def unaccepted_values(df: DataFrame, column: str, accepted: list[str], null_fails: bool = False) -> DataFrame:
    """Rows whose value is not in the list; NULL passes unless ``null_fails``."""
    wrong = ~F.col(column).isin(accepted)
    return df.filter(wrong | F.col(column).isNull() if null_fails else wrong)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, failures) for a list of columns that must be known, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "failures")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, NULLs left aside, with their row count."""
    known = reduce(lambda rows, k: rows.filter(F.col(k).isNotNull()), keys, df)
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def rule_report(
    staged: DataFrame, facts: DataFrame | None = None, brands: DataFrame | None = None
) -> DataFrame:
    """(rule, failures, status) for all rules over the layers that are given.

    Row rules of a layer share one scan; every uniqueness rule costs one
    aggregation by its key.
    """
    reports = [
        _row_rules(
            staged,
            {
                **{f"staged.{c}.not_null": F.col(c).isNull() for c in STAGED_NOT_NULL},
                "staged.source.accepted_values": ~F.col("source").isin([SOURCE_NAME]),
                "staged.condition.accepted_values": ~F.col("condition").isin(CONDITIONS),
                "discount_range": (F.col("discount_pct") < 0) | (F.col("discount_pct") > 100),
                "price_positive": F.col("price").isNull() | (F.col("price") <= 0),
                "quantity_nonnegative": F.col("num_ratings") < 0,
                "valid_condition": F.col("condition").isNull() | ~F.col("condition").isin(CONDITIONS),
            },
        ),
        _key_rule("staged.ingestion_id.unique", staged, ["ingestion_id"]),
        _key_rule("staged.product_collected.unique", staged, KEY),
    ]
    if facts is not None:
        reports += [
            _row_rules(facts, {f"facts.{c}.not_null": F.col(c).isNull() for c in FACT_NOT_NULL}),
            _key_rule("facts.product_collected.unique", facts, KEY),
        ]
    if brands is not None:
        reports += [
            _row_rules(brands, {"brands.brand.not_null": F.col("brand").isNull()}),
            _key_rule("brands.brand.unique", brands, ["brand"]),
        ]
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def run_status(report: DataFrame) -> DataFrame:
    """One row: COMPLETED, or PARTIAL when any rule failed; the data is kept either way."""
    failed = F.coalesce(F.bool_or(F.col("status") == "fail"), F.lit(False))
    return report.agg(F.when(failed, "PARTIAL").otherwise("COMPLETED").alias("run_status"))


def _row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    names = list(rules)
    counted = df.agg(*[F.count_if(rules[name]).alias(f"r{i}") for i, name in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("failures")) for i, n in enumerate(names)])
    return counted.select(F.inline(rows))


def _key_rule(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return repeated_keys(df, keys).agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("failures"))
