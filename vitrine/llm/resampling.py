"""Importance resampling of texts towards a target.

Words and word pairs are hashed to buckets.  Two bag-of-buckets models are
counted over whole tables, one for the raw texts and one for the target.  The
log of their ratio weighs a text, and Gumbel noise added to it makes taking the
largest keys a draw without replacement by those weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import stored
from vitrine.llm.words import BLANK_SEPARATED, blocks, find_words, text_bytes, windows

BUCKET_BITS = 14
BINS = 4096
AT_ONCE = 10_000
RESULT = "doc_id long, n_grams long, log_weight double"


def _buckets(block: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every word and word pair."""
    words = find_words(block, cuts, BLANK_SEPARATED, lower=True)
    shift = np.uint64(64 - BUCKET_BITS)
    pairs, whole = windows(words, 2)
    text = np.concatenate((words.text, words.text[: len(pairs)][whole]))
    return text, (np.concatenate((words.prints, pairs[whole])) >> shift).astype(np.int64)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, n over all rows of ``texts`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in blocks(offsets):
                _, bucket = _buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total += np.bincount(bucket, minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _log_model(texts: DataFrame, smoothing: float) -> np.ndarray:
    """Log probability of each bucket; there are 2 ** BUCKET_BITS, whatever the size of the table."""
    counts = np.full(1 << BUCKET_BITS, smoothing)
    for row in bucket_counts(texts).collect():
        counts[row["bucket"]] += row["n"]
    return np.log(counts / counts.sum())


def importance(docs: DataFrame, target: DataFrame, length: int | None = None, smoothing: float = 1.0) -> DataFrame:
    """doc_id, n_grams and log_weight of each row of ``docs``.

    The weight is the log of how much likelier the whole text is under the
    target's model than under the raw one: the sum over all its grams.  With
    ``length`` it is tempered: the mean over the grams times at most ``length``,
    for texts that shouldn't be decided by their length.  A text without words
    has weight 0.
    """
    ratio = _log_model(target, smoothing) - _log_model(docs, smoothing)
    held = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in blocks(offsets):
                text, bucket = _buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n = np.bincount(text, minlength=b - a)
                total = np.bincount(text, weights=held.value[bucket], minlength=b - a)
                if length is not None:
                    total = total / np.maximum(n, 1) * np.minimum(n, length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(n), pa.array(total)],
                    ["doc_id", "n_grams", "log_weight"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def gumbel(seed: int):
    """Gumbel noise that depends on doc_id and seed alone."""
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def resample(
    docs: DataFrame, target: DataFrame, share: float = 0.8, seed: int = 7, length: int | None = None
) -> DataFrame:
    """Draws ``share`` of the rows of ``docs`` without replacement, by their importance for ``target``.

    ``docs`` needs doc_id and text, ``target`` text; other columns are not read.
    Returns every row's doc_id, n_grams, log_weight, key (weight plus noise) and
    selected.  The rows with the largest keys are selected, ties going to the
    smaller doc_id; rows alike in key and doc_id are selected together, so that
    repeated rows may exceed the share.  A null or empty text weighs as one
    nobody favours; a null doc_id has noise of its own and comes last in ties.
    Without target texts all weights are 0 but for the raw model's smoothing.
    Very long texts are weighed whole.  An empty table gives an empty result.
    """
    keyed = stored(importance(docs, target, length).withColumn("key", F.col("log_weight") + gumbel(seed)), "keys")
    wanted = round(share * keyed.count())
    if not wanted:
        return keyed.withColumn("selected", F.lit(False))
    key, doc_id = _last_selected(keyed, wanted)
    own = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    return keyed.withColumn(
        "selected", (F.col("key") > F.lit(key)) | ((F.col("key") == F.lit(key)) & (own <= F.lit(doc_id)))
    )


def _last_selected(keyed: DataFrame, wanted: int) -> tuple[float, int]:
    """Key and doc_id of the last of the ``wanted`` rows with the largest keys.

    Histograms narrow the range that holds it until so few rows or keys are left
    that they can be looked at.
    """
    own = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("own")
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    within = keyed
    while True:
        width = (high - low) / BINS
        if width <= 0 or low + width == low:
            break
        number = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")
        bins = within.groupBy(number).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if row["n"] >= wanted:
                break
            wanted -= row["n"]
        low, high = row["low"], row["high"]
        within = keyed.filter(F.col("key").between(F.lit(low), F.lit(high)))
        if row["n"] <= AT_ONCE or low == high:
            break
    if low == high:  # one key: the smallest ids, found the same way
        return low, _smallest_ids(within.select(own), wanted)
    rows = sorted(((r["key"], r["own"]) for r in within.select("key", own).collect()), key=lambda r: (-r[0], r[1]))
    return rows[wanted - 1]


def _smallest_ids(ids: DataFrame, wanted: int) -> int:
    """The ``wanted``-th smallest id."""
    low, high = ids.agg(F.min("own"), F.max("own")).first()
    while low < high:
        middle = (low + high) // 2
        if ids.filter(F.col("own") <= middle).count() >= wanted:
            high = middle
        else:
            low = middle + 1
    return low
