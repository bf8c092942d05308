"""Sketches per day that can be merged for any period: distinct products and prices.

An exact distinct count or percentile of a period reads all its rows again.
These are read once, a day at a time; a period's answer merges one small row a
day.  They stand beside the exact forms, not in their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A HyperLogLog of 2**16 registers errs by 0.41 % (one standard deviation at
# most), a KLL sketch of this size by about 0.3 % in rank (at 99 %).
REGISTERS_LOG2 = 16
KLL_SIZE = 1000


def daily_sketches(rows: DataFrame, day: Column, distinct: Column, value: Column) -> DataFrame:
    """day, n, distinct_sketch and value_sketch of every day that has rows.

    Partial sketches are built before the shuffle, so a day that holds most of
    the rows is no hot key.  NULLs of ``distinct`` and of the BIGINT ``value``
    don't count; a day without any has empty sketches.
    """
    return rows.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(distinct, REGISTERS_LOG2).alias("distinct_sketch"),
        F.kll_sketch_agg_bigint(value.cast("bigint"), KLL_SIZE).alias("value_sketch"),
    )


def merged_sketches(daily: DataFrame, period: Column) -> DataFrame:
    """The days of each ``period`` merged; may be merged further."""
    return daily.groupBy(period.alias("period")).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_bigint("value_sketch", KLL_SIZE).alias("value_sketch"),
    )


def distinct_estimate(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_estimate(sketch: Column, fraction: float) -> Column:
    """A value of the period whose rank is near ``fraction``; NULL where there are no values."""
    some = F.kll_sketch_get_n_bigint(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(fraction))))
