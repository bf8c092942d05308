"""Reading and materialising the layers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.schemas import SEED

COMPRESSION = "zstd"  # of stored layers: two thirds of what snappy takes, or less
SLICE_BYTES = 32 << 20
MOST_SLICES = 32
_UNKNOWN_SIZE = 1 << 62
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder is there, on whatever file system the path names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table folder."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    below = location.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(location)
    return [status.getPath().getName() for status in below if status.isDirectory()]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within go when it is written, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)


def input_bytes(df: DataFrame) -> int:
    """Size of the files and cached tables that a plan reads; what Spark knows no size of counts nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))
    return sum(size for size in sizes if size < _UNKNOWN_SIZE)


def day_slices(df: DataFrame, day: Column) -> list[DataFrame]:
    """The rows in parts of whole days, every n-th day in one part; rows without a day are in the first.

    Written one after another, with ``shuffles_dropped``, they need shuffle files
    of one part at a time.  A part is made of ``SLICE_BYTES`` of input, but there
    are at most ``MOST_SLICES``, because each reads the input again.  Spark picks
    the days before it shuffles, if they follow from what it shuffles by.
    """
    count = min(MOST_SLICES, input_bytes(df) // SLICE_BYTES + 1)
    if count == 1:
        return [df]
    turn = F.coalesce(F.pmod(F.unix_date(day), F.lit(count)), F.lit(0))
    return [df.filter(turn == number) for number in range(count)]


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The history seed: CSV with header and declared types."""
    return spark.read.schema(SEED).option("header", True).csv(path)


def materialise_view(df: DataFrame, name: str) -> DataFrame:
    """Staging stays lazy: a view that every reader plans into its own query."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialise_table(df: DataFrame, path: str) -> DataFrame:
    """Marts are rebuilt in full and read back from storage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
