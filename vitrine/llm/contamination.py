"""Benchmark passages in training texts: a broadcast hash set of test windows, hits verified word by word."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.exchange import among
from vitrine.llm.words import ALPHANUMERIC, LOWERED, blocks, covered, find_words, text_bytes, windows

WINDOWS_PER_BLOCK = 200_000
_ITEM = "item string, length int, print long, words binary"
_HITS = "starts array<int>, lengths array<int>, items array<string>"
_RESULT = (
    T.StructType()
    .add("doc_id", "long")
    .add("n_words", "long")
    .add("n_hit", "long")
    .add("items", T.ArrayType(T.StringType()))
    .add("kept_text", "string")
)
_NAMES = ["doc_id", "n_words", "n_hit", "items", "kept_text"]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, keep_text: bool = True, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The words of each document that lie in a window of a benchmark item.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other
    columns are not read.  Texts are lower-cased in A-Z; words are runs of
    letters, digits and non-ASCII characters.  A window is ``window``
    consecutive words of an item; an item with fewer words is one window.

    Returns per document row doc_id, n_words, n_hit, items (the sorted ids of
    the items found, as strings) and kept_text, the text without its runs of
    hit words, with the separators inside a run (null unless ``keep_text``).  The
    columns in ``carry`` follow.

    A null or empty text has no words; its kept_text is "".  An item without
    words or text is nowhere found; a null item_id is reported as "".  Repeated
    rows are reported alike, repeated items once.  An empty benchmark hits
    nothing, an empty document table gives an empty result.

    The windows of the benchmark are counted first and broadcast in blocks of
    at most about WINDOWS_PER_BLOCK.  With one block a single scan without a
    shuffle does everything; with more, each block scans on its own and the
    hits of a document are put together by its id and text.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    found = items.mapInArrow(_item_windows(window), _ITEM).distinct()
    count = found.count()
    number = max(1, math.ceil(count / WINDOWS_PER_BLOCK))
    found = found.withColumn("block", F.pmod(F.xxhash64("print", "item"), F.lit(number)))
    spark = docs.sparkSession
    sets = []
    for block in range(number):
        rows = found.filter(F.col("block") == block).drop("block").collect()
        sets.append(spark.sparkContext.broadcast(_hash_set(rows)))
    texts = docs.select("doc_id", "text", *carry)
    schema = T.StructType([*_RESULT.fields, *(docs.schema[c] for c in carry)])
    if number == 1:
        return texts.mapInArrow(_scan(sets[0], keep_text), schema)
    keyed = texts.withColumn("_text_key", F.xxhash64("text"))
    asked = keyed.select("doc_id", "text", "_text_key")
    hits = asked.mapInArrow(_hits(sets[0]), "doc_id long, _text_key long, " + _HITS)
    for held in sets[1:]:
        hits = hits.unionAll(asked.mapInArrow(_hits(held), "doc_id long, _text_key long, " + _HITS))
    hits = hits.distinct().groupBy("doc_id", "_text_key").agg(
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "lengths", "items"))
    )
    joined = keyed.alias("t").join(
        hits.alias("h"), F.expr("t.doc_id <=> h.doc_id AND t._text_key = h._text_key"), "left"
    )
    chosen = joined.select("t.doc_id", "t.text", "h.starts", "h.lengths", "h.items", *(f"t.{c}" for c in carry))
    return chosen.mapInArrow(_assemble(keep_text), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop_share: float = 0.8, **options) -> DataFrame:
    """What ``find_contamination`` leaves: documents with at least ``drop_share`` of their words hit are left out."""
    found = find_contamination(docs, benchmark, **options)
    return found.filter(~((F.col("n_hit") > 0) & (F.col("n_hit") >= drop_share * F.col("n_words"))))


def _phrase(block: np.ndarray, words, at: int, length: int) -> bytes:
    return b" ".join(
        LOWERED[block[words.starts[k] : words.ends[k]]].tobytes() for k in range(at, at + length)
    )


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            items = batch.column(0).to_pylist()
            for a, b in blocks(offsets):
                block = data[offsets[a] : offsets[b]]
                words = find_words(block, offsets[a : b + 1] - offsets[a], ALPHANUMERIC, lower=True)
                rows = []
                counts = words.counts(b - a)
                starts = np.cumsum(counts) - counts
                for length in np.unique(np.minimum(counts, window)):
                    if length:
                        prints, whole = windows(words, int(length))
                        full = counts if length == window else np.where(counts == length, counts, 0)
                        for i in np.flatnonzero(full):
                            for k in range(starts[i], starts[i] + counts[i] - length + 1):
                                phrase = _phrase(block, words, k, int(length))
                                rows.append((items[a + i], int(length), int(prints[k].view(np.int64)), phrase))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(c, t)
                            for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.binary()))
                        ],
                        ["item", "length", "print", "words"],
                    )

    return run


def _hash_set(rows) -> dict[int, tuple[np.ndarray, dict[bytes, list[str]]]]:
    """By window length: the sorted fingerprints, and the items of each window."""
    out = {}
    for length in sorted({r.length for r in rows}):
        mine = [r for r in rows if r.length == length]
        prints = np.unique(np.array([r.print for r in mine], np.int64).view(np.uint64))
        items: dict[bytes, list[str]] = {}
        for r in mine:
            items.setdefault(bytes(r.words), []).append(r.item)
        out[length] = prints, items
    return out


def _search(block: np.ndarray, words, hash_set) -> tuple[np.ndarray, np.ndarray, list[tuple[int, str]]]:
    """Starts and lengths of verified windows, and (text, item) pairs."""
    starts, lengths, items = [], [], set()
    for length, (prints, by_phrase) in hash_set.items():
        own, whole = windows(words, length)
        for k in np.flatnonzero(whole & among(own, prints)).tolist():
            named = by_phrase.get(_phrase(block, words, k, length))
            if named:
                starts.append(k)
                lengths.append(length)
                items.update((int(words.text[k]), item) for item in named)
    return np.array(starts, np.int64), np.array(lengths, np.int64), sorted(items)


def _lists(values: list, rows: np.ndarray, texts: int, kind: pa.DataType) -> pa.Array:
    """Values sorted by row as one list per row."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=texts)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _outcome(block, cuts, words, starts, lengths, items: pa.Array, keep_text: bool) -> list[pa.Array]:
    texts = len(cuts) - 1
    hit = covered(starts, lengths, len(words.starts))
    kept = pa.nulls(texts, pa.string())
    if keep_text:
        run = hit[1:] & hit[:-1] & (words.text[1:] == words.text[:-1]) if len(hit) else hit
        ends = words.ends.copy()
        ends[:-1][run] = words.starts[1:][run]
        gone = covered(words.starts[hit], (ends - words.starts)[hit], len(block))
        left = np.concatenate(([0], np.cumsum(~gone)))[cuts].astype(np.int32)
        kept = pa.StringArray.from_buffers(texts, pa.py_buffer(left), pa.py_buffer(block[~gone]))
    return [
        pa.array(words.counts(texts), pa.int64()),
        pa.array(np.bincount(words.text[hit], minlength=texts), pa.int64()),
        items,
        kept,
    ]


def _scan(held, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in blocks(offsets):
                block, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words = find_words(block, cuts, ALPHANUMERIC, lower=True)
                starts, lengths, pairs = _search(block, words, held.value)
                items = _lists([p[1] for p in pairs], np.array([p[0] for p in pairs], np.int64), b - a, pa.string())
                columns = _outcome(block, cuts, words, starts, lengths, items, keep_text)
                yield _result(batch, a, b, columns, 2)

    return run


def _result(batch: pa.RecordBatch, a: int, b: int, columns: list[pa.Array], carried: int) -> pa.RecordBatch:
    """Rows of a batch with the outcome, and the batch's columns from ``carried`` on."""
    carry = batch.slice(a, b - a)
    return pa.RecordBatch.from_arrays(
        [carry.column(0).cast(pa.int64()), *columns, *carry.columns[carried:]],
        [*_NAMES, *batch.schema.names[carried:]],
    )


def _hits(held):
    """doc_id, _text_key and the hits of one block of windows, for documents that have some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in blocks(offsets):
                block, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words = find_words(block, cuts, ALPHANUMERIC, lower=True)
                starts, lengths, pairs = _search(block, words, held.value)
                counts = words.counts(b - a)
                rows = words.text[starts]
                order = np.argsort(rows, kind="stable")
                local = (starts - (np.cumsum(counts) - counts)[rows])[order]
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        batch.column(2).slice(a, b - a),
                        _lists(local, rows, b - a, pa.int32()),
                        _lists(lengths[order], rows, b - a, pa.int32()),
                        _lists([p[1] for p in pairs], np.array([p[0] for p in pairs], np.int64), b - a, pa.string()),
                    ],
                    ["doc_id", "_text_key", "starts", "lengths", "items"],
                )
                yield out.filter(pa.array(np.bincount(rows, minlength=b - a) > 0))

    return run


def _assemble(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in blocks(offsets):
                block, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words = find_words(block, cuts, ALPHANUMERIC, lower=True)
                counts = words.counts(b - a)
                first = np.cumsum(counts) - counts
                local, lengths, items = (batch.column(k).slice(a, b - a).to_pylist() for k in (2, 3, 4))
                starts = [first[i] + k for i, row in enumerate(local) for k in row or ()]
                held = [k for row in lengths for k in row or ()]
                named = pa.array([sorted(set(row or ())) for row in items], pa.list_(pa.string()))
                columns = _outcome(
                    block, cuts, words, np.array(starts, np.int64), np.array(held, np.int64), named, keep_text
                )
                yield _result(batch, a, b, columns, 5)

    return run
