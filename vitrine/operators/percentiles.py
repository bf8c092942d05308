"""Exact interpolated percentiles of groups of any size.

The built-in ``percentile`` merges a group's whole value-to-count map in one
task.  Here equal values are counted first (with map-side combining), the
counts are added up over bands of neighbouring values, and only the few bands
that hold a wanted position are looked at value by value.  Bands are narrow
where values usually lie and wide beyond, so that for money of DECIMAL(12,2) in
cents a band has at most a million values and a group about as many bands,
whatever the table size.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NARROW, WIDE = 10_000, 1_000_000
USUAL = 1_000_000_000


def exact_percentiles(df: DataFrame, keys: list[str], value: Column, wanted: dict[str, float]) -> DataFrame:
    """Percentiles of a BIGINT ``value`` per group, as DOUBLE columns named by ``wanted``.

    Groups with a NULL key or without values give no row.
    """
    valued = df.select(*keys, value.cast("bigint").alias("_value")).withColumn(
        "_band", _band(F.col("_value"))
    )
    # Both uses of the cells below carry the same filters and columns, so Spark
    # scans and shuffles them once and reuses the exchange.
    for name in [*keys, "_value"]:
        valued = valued.filter(F.col(name).isNotNull())
    cells = valued.groupBy(*keys, "_band", "_value").agg(F.count(F.lit(1)).alias("_n"))

    group = Window.partitionBy(*keys)
    bands = (
        cells.groupBy(*keys, "_band")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_start", F.sum("_n").over(group.orderBy("_band")) - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(group))
    )
    picked = bands.filter(
        reduce(
            or_,
            [
                (position >= F.col("_start")) & (position < F.col("_start") + F.col("_n"))
                for fraction in wanted.values()
                for position in _neighbours(fraction)
            ],
        )
    ).select(*keys, "_band", "_start", "_total")

    within_band = Window.partitionBy(*keys, "_band").orderBy("_value")
    placed = (
        cells.join(picked, [*keys, "_band"])
        .withColumn("_end", F.col("_start") + F.sum("_n").over(within_band))
        .withColumn("_begin", F.col("_end") - F.col("_n"))
    )
    found = placed.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[
            F.max(F.when((position >= F.col("_begin")) & (position < F.col("_end")), F.col("_value"))).alias(
                f"_{side}_{name}"
            )
            for name, fraction in wanted.items()
            for side, position in zip(("low", "high"), _neighbours(fraction))
        ],
    )
    return found.select(
        *keys,
        *[
            (
                F.col(f"_low_{name}")
                + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (_place(fraction) - F.floor(_place(fraction)))
            ).alias(name)
            for name, fraction in wanted.items()
        ],
    )


def _band(value: Column) -> Column:
    """Number of the band of a value; never falls as the value grows."""
    edge = USUAL // NARROW
    band = (
        F.when(value >= USUAL, edge + F.floor((value - USUAL) / WIDE))
        .when(value <= -USUAL, -edge + F.floor((value + USUAL) / WIDE))
        .otherwise(F.floor(value / NARROW))
    )
    # never NULL, so that a join on it needs no null filter on one of its sides only
    return F.coalesce(band, F.lit(0))


def _place(fraction: float) -> Column:
    return (F.col("_total") - 1) * F.lit(float(fraction))


def _neighbours(fraction: float) -> tuple[Column, Column]:
    return F.floor(_place(fraction)), F.ceil(_place(fraction))


def combine_groups(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Aggregates of the same groups, side by side; NULL keys meet each other.

    Each part has at most one row per group and its own measures, so stacking
    them and taking the known value needs one small shuffle and also works for
    the single group of an ungrouped aggregate, where a join would have no key.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
