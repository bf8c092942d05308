"""Row counts of all layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame], written: dict[str, int] | None = None) -> DataFrame:
    """(table_name, row_count) per table, ordered by name; only tables not ``written`` just now are counted."""
    written = written or {}
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
        if name not in written
    ]
    if written:
        spark = next(iter(tables.values())).sparkSession
        counts.append(spark.createDataFrame(sorted(written.items()), "table_name string, row_count bigint"))
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
