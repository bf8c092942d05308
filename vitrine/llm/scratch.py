"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vitrine.session import scratch_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` below the cluster's shared folder and reads it back: cuts lineage, survives lost executors."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
