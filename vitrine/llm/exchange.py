"""Questions about fingerprints, asked by parts of a collection and answered for all of it.

Documents are dealt to parts by a hash of their id.  A part sends the sorted,
distinct fingerprints it asks about, cut into buckets by value; one row holds a
bucket's fingerprints of one part, packed.  A bucket sees what all parts sent
and answers each part.  A fingerprint travels once per part however often it
occurs there, so a passage that a third of all documents share costs a bucket no
more than one entry per part.  There are two parts and one
bucket to each shuffle partition, the setting that is sized to the data.

All stages read the documents through one shuffle by part, which Spark reuses.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENT = "bucket int, part int, kind int, keys binary, notes binary"
ANSWERED = "part int, kind int, keys binary, notes binary"
_ARROW = {
    name: pa.schema([(c, pa.binary() if c in ("keys", "notes") else pa.int32()) for c in columns])
    for name, columns in (
        ("sent", ["bucket", "part", "kind", "keys", "notes"]),
        ("answered", ["part", "kind", "keys", "notes"]),
    )
}
BUCKET_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max


def parts_of(df: DataFrame) -> int:
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def buckets_of(df: DataFrame) -> int:
    """One bucket to each shuffle partition, fewer for a small input: a row goes from each part to each bucket.

    The input's size is Spark's own estimate, the size of its files for a table.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(parts_of(df) // 2, -(-size // BUCKET_BYTES)))


def dealt(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns, a key and the part of each document.

    A missing id sorts after all others, and the text decides on the part.
    """
    return docs.select(
        *columns,
        F.coalesce("doc_id", F.lit(int(NO_ID))).cast("long").alias("key"),
        F.pmod(
            F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(parts_of(docs))
        ).cast("int").alias("part"),
    )


def distinct(keys: np.ndarray, *also: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, the order that sorts them, and where each group starts and ends in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(keys) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(keys))
    return ranked[first], order, first, last


def among(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which values occur in a sorted array."""
    if not len(ranked):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
    return ranked[place] == values


def send(part: int, kind: int, keys: np.ndarray, notes: np.ndarray | None, buckets: int) -> Iterator[tuple]:
    """Rows for sorted keys, one per bucket of their range."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    cuts = [0, *np.searchsorted(keys, edges), len(keys)]
    for bucket in range(buckets):
        a, b = cuts[bucket], cuts[bucket + 1]
        if b > a:
            yield bucket, part, kind, keys[a:b].tobytes(), b"" if notes is None else notes[a:b].tobytes()


def as_table(rows: Iterator[tuple], kind: str) -> pa.Table:
    """Sent or answered rows as an Arrow table."""
    columns = list(zip(*rows, strict=True)) or [[]] * len(_ARROW[kind])
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ARROW[kind], strict=True)], schema=_ARROW[kind])


@dataclass
class Sent:
    """All entries of one kind that a bucket or part has got; ``row`` says from which row each came."""

    keys: np.ndarray
    notes: np.ndarray
    row: np.ndarray
    parts: list[int]
    cuts: np.ndarray


def entries(table: pa.Table, kind: int, notes: np.dtype | None = None) -> Sent:
    rows = [i for i, k in enumerate(table.column("kind").to_pylist()) if k == kind]
    names = table.column("part").to_pylist()
    # by part, so that an answer doesn't depend on the order in which rows arrive
    rows.sort(key=names.__getitem__)
    keys = [np.frombuffer(table.column("keys")[i].as_py(), np.uint64) for i in rows]
    sizes = [len(k) for k in keys]
    values = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    if notes is None:
        about = np.zeros(len(values), np.uint8)
    else:
        held = [np.frombuffer(table.column("notes")[i].as_py(), notes) for i in rows]
        about = np.concatenate(held) if held else np.zeros(0, notes)
    return Sent(values, about, np.repeat(np.arange(len(rows)), sizes), [names[i] for i in rows], np.cumsum([0, *sizes]))


def answer(sent: Sent, kind: int, chosen: np.ndarray, notes: np.ndarray | None = None) -> Iterator[tuple]:
    """To each part its own chosen entries, with the notes of all entries cut alike."""
    for i, part in enumerate(sent.parts):
        a, b = sent.cuts[i], sent.cuts[i + 1]
        mine = chosen[a:b]
        if mine.any():
            yield part, kind, sent.keys[a:b][mine].tobytes(), b"" if notes is None else notes[a:b][mine].tobytes()


def known(table: pa.Table, kind: int) -> np.ndarray:
    """The sorted fingerprints a part was answered."""
    return np.sort(entries(table, kind).keys)


def tidy(table: pa.Table) -> pa.Table:
    """Gives the memory that a group's arrays have left behind back to the system; a worker lives on for many groups."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # a C library without it
    return table


def ask(docs: DataFrame, answers: DataFrame | None, sender: Callable, answerer: Callable) -> DataFrame:
    """One round: ``sender(documents, answers)`` per part, then ``answerer(entries)`` per bucket.

    Both return row tuples; ``answers`` holds those of the rounds before, None in the first.
    """
    if answers is None:
        sent = docs.groupBy("part").applyInArrow(lambda table: tidy(as_table(sender(table, None), "sent")), SENT)
    else:
        sent = (
            docs.groupBy("part")
            .cogroup(answers.groupBy("part"))
            .applyInArrow(lambda table, got: tidy(as_table(sender(table, got), "sent")), SENT)
        )
    return sent.groupBy("bucket").applyInArrow(lambda table: tidy(as_table(answerer(table), "answered")), ANSWERED)


def finish(docs: DataFrame, answers: DataFrame, last: Callable, schema: str) -> DataFrame:
    """The final round: ``last(documents, answers)`` per part, an Arrow table of ``schema``."""
    return docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(lambda table, got: tidy(last(table, got)), schema)
