"""Row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import scratch_folder
from vitrine.sources.tables import materialise_table


def observation_ranks(df: DataFrame, key: str, instant: str, tiebreak: list[str]) -> DataFrame:
    """Adds rank_asc, rank_desc and num_observations of each row within ``key``.

    A window over the whole key would sort a heavy product in one task.  Here
    the rows are range-partitioned by key, instant and tiebreak (together
    unique), which cuts a heavy key into slices of even size whatever it is
    heavy with, and stored with their slice, so that all that follows sees the
    same slices.  Rows are numbered within key and slice and shifted by the
    rows in the slices before; that table has at most one row per key and slice.
    """
    rows = even_slices(df, [key, instant, *tiebreak])
    earlier = Window.partitionBy(key).orderBy("_slice")
    offsets = (
        rows.groupBy(key, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            key,
            "_slice",
            (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(key)).alias("num_observations"),
        )
    )
    within_slice = Window.partitionBy(key, "_slice").orderBy(instant, *tiebreak)
    return (
        rows.join(offsets, [key, "_slice"])
        .withColumn("rank_asc", F.col("_before") + F.row_number().over(within_slice))
        .withColumn("rank_desc", F.col("num_observations") + 1 - F.col("rank_asc"))
        .drop("_slice", "_before")
    )


def even_slices(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` as a stored table with ``_slice``: consecutive ranges of ``order`` of about equal size."""
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id())
    return materialise_table(ranged, scratch_folder(spark, "ranks"))
