"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "vitrine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    On a cluster leave ``master`` to spark-submit and pass
    ``spark.sql.shuffle.partitions`` as two to three times the core count:
    adaptive execution merges what is too small.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.scheduler.mode": "FAIR",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_small_methods(spark)
    keep_state_on_disk(spark)
    return spark


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streaming state in RocksDB instead of the executors' heap; called wherever a stateful stream is built."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)


def use_small_methods(spark: SparkSession) -> None:
    """Keeps generated code within what the JIT compiles.

    HotSpot interprets methods over 8000 bytes.  The wide projections of
    staging and message parsing exceed that when fused into one stage method;
    past this limit Spark generates split code per operator instead, which ran
    three times faster.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one the cluster names in spark.checkpoint.dir.

    Where that is unset and the session runs in local mode (tests, a laptop)
    a temporary folder serves; a cluster without it is refused, because its
    executors could not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
