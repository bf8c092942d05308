"""The fact set and its incremental upkeep."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.labels import bucket_end, bucket_start, price_segment
from vitrine.operators.keyed import merge_on_key
from vitrine.schemas import FACT_COLUMNS, FACTS, KEY, missing_fields
from vitrine.sources.tables import COMPRESSION, day_slices, exists, folder_names, remove, shuffles_dropped

BLOOM_SIZES = 11  # tried for each file: 1 MB, half of it and so on, down to 1 KB


def value_score(rating: Column, num_ratings: Column, price: Column) -> Column:
    """``round(rating * num_ratings / price, 4)``; NULL without a rating or price."""
    score = F.round(F.try_divide(rating * num_ratings, price), 4).cast("decimal(18,4)")
    return F.when((price > 0) & (rating > 0), score)


def facts(staged: DataFrame) -> DataFrame:
    """Real observations with date, price bands and value score (30 columns)."""
    price = F.col("price")
    return (
        staged.filter(~F.col("seed_flag"))
        .withColumns(
            {
                "collection_date": F.to_date("collected_at"),
                "price_bucket": price_segment(price),
                "price_bucket_500_start": bucket_start(price),
                "price_bucket_500_end": bucket_end(price),
                "value_score": value_score(F.col("rating"), F.col("num_ratings"), price),
            }
        )
        .select(*FACT_COLUMNS)
    )


def newer_rows(candidates: DataFrame, loaded: DataFrame) -> DataFrame:
    """Candidates collected after everything already loaded; all of them if nothing is.

    Rows at or before the high watermark are dropped even if their key is new.
    """
    kind = candidates.schema["collected_at"].dataType
    watermark = loaded.agg(
        F.coalesce(F.max("collected_at"), F.lit("0001-01-01 00:00:00").cast(kind)).alias("w")
    ).scalar()
    return candidates.filter(F.col("collected_at") > watermark)


def upserted(loaded: DataFrame, candidates: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """The fact set after one incremental run.

    A key with the instant in it can't be there already, because new rows are
    later than all loaded ones; other keys are merged.
    """
    fresh = newer_rows(candidates, loaded)
    return loaded.unionByName(fresh) if "collected_at" in keys else merge_on_key(loaded, fresh, keys)


def loads_path(path: str) -> str:
    """Beside the fact table: what each finished load has written, a row per collection date."""
    return f"{path}_loads"


def finished_loads(spark: SparkSession, path: str) -> DataFrame:
    """(load, base, collection_date, rows, watermark); a load with ``base`` holds all that was loaded before it."""
    return spark.read.option("recursiveFileLookup", True).parquet(loads_path(path))


def current_loads(spark: SparkSession, path: str) -> DataFrame:
    """The loads that make up the table: the last base and those after it."""
    loads = finished_loads(spark, path)
    bases = loads.filter("base").agg(F.coalesce(F.max("load"), F.lit(-1)).alias("from_load"))
    return loads.join(bases).filter(F.col("load") >= F.col("from_load")).drop("from_load")


def write_facts(df: DataFrame, path: str, load: int = 0, base: bool = False) -> None:
    """Adds ``df`` as one load, and then the load's rows to the table of loads.

    Each load has a folder of its own with its collection dates below, so that
    no file that is read is ever replaced; a load that was broken off isn't
    listed and is replaced by the next try.  Its line in the table of loads is
    one file, which a reader sees in whole or not at all.

    The rebalance hint lets adaptive execution split a heavy date over many
    files and pack small ones together.  Within a file the rows go by brand and
    price, so that the bounds of a row group say something about either, and
    Bloom filters tell which files have a product.  A filter is as big as the
    file's products need, since a date may have few: of fixed size it takes 1 MB.

    A big load is written by slices of its dates, each date in one of them, so
    that the disk holds the shuffle files of one slice besides the facts.
    """
    lacking = missing_fields(df.schema, FACT_COLUMNS)
    if lacking:
        raise ValueError(f"facts lack {', '.join(lacking)}")
    target = f"{path}/load={load}"
    with shuffles_dropped(df.sparkSession):
        for number, rows in enumerate(day_slices(df, F.col("collection_date"))):
            (
                rows.hint("rebalance", "collection_date")
                .sortWithinPartitions("collection_date", "brand", "price")
                .write.mode("append" if number else "overwrite")
                .option("partitionOverwriteMode", "static")
                .option("compression", COMPRESSION)
                .option("parquet.bloom.filter.enabled#product_id", "true")
                .option("parquet.bloom.filter.adaptive.enabled", "true")
                .option("parquet.bloom.filter.candidates.number#product_id", BLOOM_SIZES)
                .partitionBy("collection_date")
                .parquet(target)
            )
        written = df.sparkSession.read.schema(df.schema).parquet(target)
        (
            written.groupBy("collection_date")
            .agg(F.count(F.lit(1)).alias("rows"), F.max("collected_at").alias("watermark"))
            .select(F.lit(load).cast("bigint").alias("load"), F.lit(base).alias("base"), "collection_date", "rows", "watermark")
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(f"{loads_path(path)}/{load:012d}")
        )


def read_facts(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The rows of the current loads, from the collection date ``since`` on if it is given.

    Their folders are taken from the table of loads, so the fact tree is not
    listed; a filter on ``collection_date`` prunes them further.
    """
    loads = current_loads(spark, path)
    if since is not None:
        loads = loads.filter(F.col("collection_date") >= F.lit(since))
    folders = [
        f"{path}/load={row.load}/collection_date={row.collection_date}"
        for row in loads.select("load", "collection_date").collect()
    ]
    if not folders:  # of the right shape, without a row; there may be no load with one either
        return spark.createDataFrame([], FACTS)
    return spark.read.option("basePath", path).parquet(*folders).select(*FACT_COLUMNS)


def upsert_facts(spark: SparkSession, path: str, candidates: DataFrame) -> None:
    """One incremental run against a fact table on disk, or its first load.

    The high watermark comes from the table of loads; no fact is read.
    """
    if not exists(spark, loads_path(path)):
        write_facts(candidates, path)
        return
    loads = finished_loads(spark, path)
    done = loads.select(F.col("watermark").alias("collected_at"))
    write_facts(newer_rows(candidates, done), path, next_load(spark, path))


def next_load(spark: SparkSession, path: str) -> int:
    """Loads are numbered by their lines in the table of loads, those without a row included."""
    folders = [int(name) for name in folder_names(spark, loads_path(path))]
    return max(folders, default=-1) + 1


def compact_facts(spark: SparkSession, path: str) -> None:
    """Writes the current loads anew as one, the base of those to come.

    Readers go on with the old loads until its line is in the table of loads
    and with the new one from then on; the old files stay for those who have
    begun to read them, until ``remove_replaced``.
    """
    write_facts(read_facts(spark, path), path, next_load(spark, path), base=True)


def remove_replaced(spark: SparkSession, path: str) -> list[int]:
    """Deletes the folders of loads before the last base, and returns their numbers.  Their lines stay."""
    kept = current_loads(spark, path).agg(F.min("load")).first()[0]
    numbers = [int(name.removeprefix("load=")) for name in folder_names(spark, path) if name.startswith("load=")]
    old = sorted(n for n in numbers if kept is not None and n < kept)
    for number in old:
        remove(spark, f"{path}/load={number}")
    return old
