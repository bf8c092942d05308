"""Tumbling event-time windows over a stream, kept in a table that can be read at any time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.functions.numeric import PRICE_SCALE, mean
from vitrine.operators.keyed import first_per_key
from vitrine.session import keep_state_on_disk
from vitrine.sources.tables import remove


def utc_instant(local: Column) -> Column:
    """A timestamp without zone taken as UTC, whatever the session zone is."""
    return F.from_utc_timestamp(local.cast("timestamp"), F.current_timezone())


def utc_local(instant: Column) -> Column:
    """Inverse of :func:`utc_instant`."""
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def hourly_counts(stream: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Observations per collection hour."""
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "n")
    )


def daily_prices(stream: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Daily price series; percentiles stay with the batch mart."""
    return (
        stream.filter("price > 0")
        .withWatermark(event_time, delay)
        .groupBy(F.window(event_time, "1 day").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_observations"),
            mean(F.col("price"), PRICE_SCALE, 2).alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .select(F.col("w.start").alias("window_start"), "total_observations", "avg_price", "min_price", "max_price")
    )


def start_window_table(windows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes every batch's changed windows under its epoch; a retried epoch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        (
            batch.withColumn("epoch", F.lit(epoch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("epoch")
            .parquet(folder)
        )

    keep_state_on_disk(windows.sparkSession)
    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def window_table(spark: SparkSession, folder: str) -> DataFrame:
    """The current state: the newest epoch of every window; a merged one counts as the last it holds."""
    as_of = F.when(F.col("epoch") < 0, -F.col("epoch") - 1).otherwise(F.col("epoch"))
    return first_per_key(spark.read.parquet(folder), ["window_start"], [as_of.desc(), F.col("epoch")]).drop("epoch")


def compact_windows(spark: SparkSession, folder: str) -> None:
    """Merges all epochs into one, so that reading takes as many files as the windows need.

    The merged state of the epochs up to n is written as epoch -n - 1 and stands
    for n; only then the others go.  Broken off in between, both say the same.
    """
    epochs = [r["epoch"] for r in spark.read.parquet(folder).select("epoch").distinct().collect()]
    latest = max(-e - 1 if e < 0 else e for e in epochs)
    merged = -latest - 1
    if epochs == [merged]:
        return
    if merged not in epochs:
        (
            window_table(spark, folder)
            .withColumn("epoch", F.lit(merged).cast("bigint"))
            .hint("rebalance")
            .write.mode("append")
            .partitionBy("epoch")
            .parquet(folder)
        )
    for epoch in epochs:
        if epoch != merged:
            remove(spark, f"{folder}/epoch={epoch}")
