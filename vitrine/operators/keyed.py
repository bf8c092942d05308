"""One row per key, keyed merges and keyed appends.

All of them survive one key holding a large part of the rows: picking a row
per key uses a rank filter, which Spark also applies before the shuffle, so a
task sends at most one row per key; the anti-joins have unique keys on the
side that is built.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in ``order``, which must be total within a key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).filter("_position = 1").drop("_position")


def known_key(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def unseen_rows(incoming: DataFrame, target: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of ``incoming`` that a first-row-wins append adds to ``target``.

    ``target`` holds each complete key once.  Rows with a NULL in the key
    equal nothing, not even each other: all of them are added, and they take
    no part in the shuffle.
    """
    complete = known_key(keys)
    candidates = first_per_key(incoming.filter(complete), keys, order)
    held = target.filter(complete).select(*keys)
    return candidates.join(held, keys, "left_anti").unionByName(incoming.filter(~complete))


def append_unseen(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return target.unionByName(unseen_rows(incoming, target, keys, order))


def append_outcomes(incoming: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row: messages seen, rows a first-row-wins append inserts, duplicates it ignores."""
    complete = known_key(keys)
    per_key = (
        incoming.filter(complete)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(target.filter(complete).select(*keys).withColumn("held", F.lit(True)), keys, "left")
        .select("copies", F.when(F.col("held"), 0).otherwise(1).alias("new"))
    )
    keyless = incoming.filter(~complete).select(
        F.lit(1).cast("bigint").alias("copies"), F.lit(1).alias("new")
    )
    totals = per_key.unionByName(keyless).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("inserted"),
    )
    return totals.withColumn("duplicates", F.col("processed") - F.col("inserted"))


def merge_on_key(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing those of equal key."""
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)
