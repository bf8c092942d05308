"""Partitioning of input that Spark cannot split by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame

SETTING = "spark.vitrine.inputPartitions"


def as_asked(scan: DataFrame) -> DataFrame:
    """A scan dealt out to as many partitions as the session asks for, or as it is if it asks for none.

    For the case of a few files that cannot be split, such as a Parquet file
    with one row group.  Tables of many splits need no setting.
    """
    wanted = scan.sparkSession.conf.get(SETTING, None)
    return scan.repartition(int(wanted)) if wanted else scan
