"""Publishing records as a stream: each is sent once, however often the sender is restarted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.schemas import DEAD_LETTER, LANDED, RECORD, missing_fields
from vitrine.sources import messages as msg


def start_publish(records: DataFrame, folder: str, dead_folder: str, checkpoint: str) -> list[StreamingQuery]:
    """Lands a stream of records as JSON messages, those without a required value among the dead letters.

    Two queries with a checkpoint each, which take in what is there and stop;
    started again, they go on from there.  The files of a micro-batch count
    from the moment the sink's log names them, all at once: what an attempt that
    was broken off has left behind is in no log, and a batch that is in the log
    already is not added again.  Readers have to go by the log, as Spark's file
    source does.

    Ids are made of a record's instant and ingestion id, not of its place in a
    batch, so that every attempt gives the same ones; they sort by time.
    """
    lacking = missing_fields(records.schema, RECORD)
    if lacking:
        raise ValueError(f"records lack {', '.join(lacking)}")
    error = msg.unsendable()
    micros = F.unix_micros(F.col("collected_at").cast("timestamp"))
    message_id = F.concat(F.format_string("%019d-", micros), F.col("ingestion_id")).alias("message_id")
    sent = msg.envelope(records.filter(error.isNull()), message_id)
    return [
        _started(sent, "json", folder, f"{checkpoint}/sent"),
        _started(msg.publish_failures(records, error), "parquet", dead_folder, f"{checkpoint}/refused"),
    ]


def _started(rows: DataFrame, kind: str, folder: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format(kind).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
    )


def sent_messages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LANDED).json(folder)


def refused_records(spark: SparkSession, dead_folder: str) -> DataFrame:
    return spark.read.schema(DEAD_LETTER).parquet(dead_folder)
