"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte bigrams and trigrams of its lower-cased
letters, weighted by TF-IDF and normalised.  Each language has a few centroids,
clustered from a bounded sample of labelled texts.  The language of the centroid
with the largest cosine is predicted; a text far from it is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.words import blocks, text_bytes

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
RESULT = "doc_id long, lang_pred string, score double, rejected boolean"

# Letters and all non-ASCII bytes stay, all other bytes count as a blank.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Centroids:
    """What a text is compared with; ``least`` is the cosine below which a text is rejected."""

    languages: list[str]
    weights: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of hashed bigram and trigram counts per text."""
    texts, size = len(offsets) - 1, int(offsets[-1])
    out = np.zeros((texts, BUCKETS), np.float32)
    if size < 2:
        return out
    letters = _LETTERS[data].astype(np.uint32)
    text = np.repeat(np.arange(texts, dtype=np.int64), np.diff(offsets))
    pair = letters[:-1] << np.uint32(8) | letters[1:]
    for length, code in ((2, pair), (3, pair[:-1] << np.uint32(8) | letters[2:])):
        whole = text[: len(code)] == text[length - 1 :]
        whole &= (code & np.uint32(0xFFFF)) != 0x2020
        bucket = (code[whole] + np.uint32(length)) * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKET_BITS)
        found = np.bincount(text[: len(code)][whole] * BUCKETS + bucket, minlength=texts * BUCKETS)
        out += found.reshape(texts, BUCKETS)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(size, 1e-9)


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = text_bytes(pc.utf8_lower(batch.column(column).cast(pa.large_string())))
    first = 0
    while first < batch.num_rows:  # at most 128 dense rows, and about 1 MB of text, at a time
        part = offsets[first : first + 129]
        _, b = next(blocks(part - part[0]))
        cuts = part[: b + 1] - part[0]
        yield first, first + b, gram_counts(data[part[0] : part[b]], cuts)
        first += b


def train(labelled: DataFrame, sample_rows: int = 4000, clusters: int = 4, leniency: float = 0.4) -> Centroids | None:
    """Centroids from rows with text and lang, or None if there are none with a letter.

    At most ``sample_rows`` rows are used, the same number of each language and
    one of each doc_id, taken by a hash of doc_id.  ``leniency`` times the cosine that all but one
    in a hundred of a language's texts reach is the least a text may have.
    """
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    ids = rows.select("lang", "doc_id").distinct()
    counts = {r["lang"]: r["count"] for r in ids.groupBy("lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    each = max(1, sample_rows // len(languages))
    # a hash leaves about four times as many as are wanted, so that the ranking is small whatever the table's size
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, 4 * each / counts[lang]))))
    place = (F.xxhash64("doc_id").cast("double") / 2.0**64) + 0.5
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = (
        rows.select("doc_id", "lang", place.alias("place"), F.xxhash64("text").alias("print"))
        .filter(F.col("place") <= share[F.col("lang")])
        .groupBy("doc_id", "lang", "place")
        .agg(F.min("print").alias("print"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= each)
    )
    key = ["doc_id", "lang", "print"]
    sample = rows.withColumn("print", F.xxhash64("text")).join(chosen.select(*key), key).dropDuplicates(key)
    sample = sample.select("doc_id", "lang", "text")
    held = sorted(
        (r.lang, r.doc_id or 0, bytes(r.grams))
        for r in sample.mapInArrow(_log_counts, "doc_id long, lang string, grams binary").collect()
    )
    names = np.array([lang for lang, _, _ in held])
    tf = np.array([np.frombuffer(g, np.float16) for _, _, g in held], np.float32).reshape(len(held), BUCKETS)
    useful = tf.any(axis=1)
    names, tf = names[useful], tf[useful]
    if not len(names):
        return None
    weights = np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))).astype(np.float32) + 1
    vectors = _unit(tf * weights)
    centroids, owner, least = [], [], []
    languages = [lang for lang in languages if (names == lang).any()]
    for number, lang in enumerate(languages):
        mine = vectors[names == lang]
        found, member = _spherical_clusters(mine, clusters)
        near = (mine * found[member]).sum(axis=1)
        centroids.extend(found)
        owner.extend([number] * len(found))
        least.extend([leniency * float(np.quantile(near, 0.01))] * len(found))
    return Centroids(languages, weights, np.array(centroids), np.array(owner), np.array(least))


def _log_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, counts in _batches(batch, 2):
            grams = [row.tobytes() for row in np.log1p(counts).astype(np.float16)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    batch.column(1).slice(a, b - a).cast(pa.string()),
                    pa.array(grams, pa.binary()),
                ],
                ["doc_id", "lang", "grams"],
            )


def _spherical_clusters(vectors: np.ndarray, clusters: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and the cluster of each vector.

    Starts from vectors spread evenly over their nearness to the mean; a
    cluster with less than a twentieth of the vectors is given up, so that no
    odd text becomes a centroid of its own.
    """
    near = np.argsort(vectors @ _unit(vectors.mean(axis=0, keepdims=True))[0], kind="stable")
    places = (np.arange(clusters) + 0.5) / clusters * len(vectors)
    centroids = vectors[near[np.unique(places.astype(int))]]
    for _ in range(rounds):
        member = np.argmax(vectors @ centroids.T, axis=1)
        sizes = np.bincount(member, minlength=len(centroids))
        kept = np.flatnonzero((sizes >= len(vectors) / 20) & (sizes > 0))
        centroids = _unit(np.array([vectors[member == k].mean(axis=0) for k in kept]))
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def _sent(docs: DataFrame, model: Centroids | None):
    """The model's parts for all tasks; its class is not sent along, executors may lack this package."""
    return docs.sparkSession.sparkContext.broadcast(model and tuple(vars(model).values()))


def _received(held) -> Centroids | None:
    return held.value and Centroids(*held.value)


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """Language, cosine and rejection of each row of ``docs`` (doc_id, text; other columns are not read).

    A text that is null or has no letter is ``und`` with score 0 and rejected,
    as is every text if nothing could be learned.  Every other text gets the
    nearest learned language, its score the cosine cut to 0..1, and is rejected
    if that is below what the centroid asks for.  Ties go to the language that
    sorts first.  Repeated rows are judged alike; an empty table gives none.
    """
    held = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, lang, score, far in _judged(batch, 1, _received(held)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        pa.array(lang, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(far, pa.bool_()),
                    ],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def accepted(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``identify`` doesn't reject."""
    held = _sent(docs, model)
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, _, far in _judged(batch, column, _received(held)):
                yield batch.slice(a, b - a).filter(pa.array(~far))

    return docs.mapInArrow(run, docs.schema)


def _judged(batch: pa.RecordBatch, column: int, model: Centroids | None):
    """Ranges of a batch's rows with their language, score and rejection."""
    with_letter = pc.fill_null(pc.match_substring_regex(batch.column(column), r"\p{L}"), False)
    with_letter = with_letter.to_numpy(zero_copy_only=False)
    for a, b, counts in _batches(batch, column):
        known = with_letter[a:b]
        score, lang, far = np.zeros(b - a), np.full(b - a, UNKNOWN, object), np.ones(b - a, bool)
        if model is not None and known.any():
            cosines = _unit(np.log1p(counts[known]) * model.weights) @ model.centroids.T
            best = np.argmax(cosines, axis=1)
            near = cosines[np.arange(len(best)), best]
            score[known] = np.clip(near, 0, 1)
            lang[known] = np.array(model.languages, object)[model.owner[best]]
            far[known] = near < model.least[best]
        yield a, b, lang, score, far


def is_held_out(doc_id="doc_id"):
    """The rows that are never learned from: crc32 of the id as text leaves 2 modulo 4 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
