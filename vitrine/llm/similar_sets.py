"""Groups of documents with similar n-gram sets: an exact Jaccard join by prefix trees.

Each document is the set of its word n-grams, globally ordered by how many
documents have them, the rarest first.  Two similar sets share a token among
the first few of either; only tokens that at least two documents have count.
The documents with such a token meet in a bin, named after the smallest of
them, where a prefix tree finds the similar ones.

Equal sets are reduced to their first document beforehand.  The members of a
token with more than HOT documents don't meet in one place: each is compared
with the smallest of them, and only those that are not similar to it are
compared with all the others, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.components import components
from vitrine.llm.exchange import SENT, answer, as_table, ask, buckets_of, dealt, distinct, entries, send
from vitrine.llm.prefix_tree import PrefixTree
from vitrine.llm.scratch import stored
from vitrine.llm.words import BLANK_SEPARATED, blocks, find_words, mixed, text_bytes, windows

HOT = 1_000
BLOCK_DOCS = 2_000
UNNAMED = 1 << 62
COUNTS, SETS, PIVOTS, MEMBERS, BINS, CROWDS = range(6)
_MEMBER, _EDGE, _CROWD = range(3)
_SET = np.dtype([("check", np.uint64), ("key", np.int64)])
_PIVOT = np.dtype([("key", np.int64), ("docs", np.uint32)])
_HEAD = np.dtype([("bin", np.int64), ("key", np.int64), ("size", np.int64), ("sent", np.int64)])
_ROWS = "kind int, a long, b long, n long, tokens binary"
_ROWS_ARROW = pa.schema(
    [("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())]
)
_TOP = np.uint64(16)


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Documents connected by similar sets of ``words``-word shingles.

    ``docs`` needs doc_id and text; other columns are not read.  Texts are
    lower-cased in A-Z; words are runs of bytes other than blank and \\x09-\\x0D;
    a text of fewer words has its whole sequence as its one shingle.  Two sets
    are similar if 100 * intersection >= percent * union.  Returns per row
    doc_id, n_shingles and component_id, the smallest doc_id reachable over
    similar sets, its own included.

    A null or empty text has an empty set, which is similar to nothing.  Rows
    with the same doc_id are one node.  A null doc_id is reported as null; such
    a row still connects others, and its component_id is null if it reaches no
    doc_id.  An empty table gives an empty result.
    """
    component = F.col("component")
    return _groups(docs, words, percent).select(
        F.when(F.col("key") < UNNAMED, F.col("key")).alias("doc_id"),
        "n_shingles",
        F.when(component < UNNAMED, component).alias("component_id"),
    )


def first_of_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document of each group: the one with the smallest doc_id.

    Of rows with the same doc_id the one with the smallest text stays.  Rows
    without doc_id stay if they are similar to none with one, equal texts once.
    """
    first = _groups(docs, words, percent).filter("key = component").select(F.col("key").alias("_key")).distinct()
    order = Window.partitionBy("_key").orderBy("text")
    return (
        docs.withColumn("_key", _key())
        .join(first, "_key", "left_semi")
        .withColumn("_rank", F.row_number().over(order))
        .filter("_rank = 1")
        .select(*docs.columns)
    )


def _key():
    """The doc_id, or a large number made of the text where it is missing."""
    return F.coalesce("doc_id", F.lit(UNNAMED) + F.shiftrightunsigned(F.xxhash64("text"), 3))


def _groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """key, n_shingles and component of each row."""
    buckets = buckets_of(docs)
    texts = dealt(docs, "doc_id", "text").withColumn("key", _key())
    counted = ask(texts, None, *_token_counts(words, percent, buckets))
    answers = counted.unionAll(ask(texts, counted, *_pivots(words, percent, buckets)))
    sent = (
        texts.groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInArrow(lambda table, got: as_table(_bins(words, percent, buckets)(table, got), "sent"), SENT)
    )
    rows = stored(sent.groupBy("bucket").applyInArrow(_joined(percent), _ROWS), "sets")
    edges = rows.filter(F.col("kind") == _EDGE).select("a", "b")
    crowds = rows.filter(F.col("kind") == _CROWD).select(F.col("a").alias("pivot"), F.col("b").alias("key"), "n", "tokens")
    if not crowds.isEmpty():
        edges = edges.unionAll(_crowd_edges(crowds, percent))
    members = rows.filter(F.col("kind") == _MEMBER).select(
        F.col("a").alias("key"), F.col("b").alias("first"), F.col("n").alias("n_shingles")
    )
    # rows of one doc_id with different sets
    several = members.groupBy("key").agg(F.min("first").alias("least"), F.max("first").alias("most"))
    several = several.filter("least < most").select("key", "least")
    edges = edges.unionAll(members.join(several, "key").select("first", "least"))
    labels = stored(components(edges), "labels")
    found = members.join(labels, members["first"] == labels["node"], "left")
    return found.select("key", "n_shingles", F.coalesce("label", "first").alias("component"))


# --- sets of a part ----------------------------------------------------------------------


@dataclass
class Sets:
    """Distinct shingles of each document of a part, one after another; ``order`` sorts them all."""

    part: int
    keys: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    doc: np.ndarray
    order: np.ndarray
    group: np.ndarray
    firsts: np.ndarray
    prints: np.ndarray
    checks: np.ndarray


def _sets(table: pa.Table, words: int) -> Sets:
    data, offsets = text_bytes(table.column("text"))
    tokens, docs = [], []
    for a, b in blocks(offsets):
        found = find_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], BLANK_SEPARATED, lower=True)
        counts = found.counts(b - a)
        starts = np.cumsum(counts) - counts
        prints, whole = windows(found, words)
        doc = [found.text[: len(prints)][whole]]
        own = [prints[whole]]
        for short in range(1, words):
            few = np.flatnonzero(counts == short)
            if len(few):
                own.append(windows(found, short)[0][starts[few]])
                doc.append(few)
        own, doc = np.concatenate(own), np.concatenate(doc)
        order = np.lexsort((own, doc))
        own, doc = own[order], doc[order]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
        tokens.append(own[new])
        docs.append((doc[new] + a).astype(np.int32))
    # places as 32-bit numbers: a part has far fewer tokens than they reach
    tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
    doc = np.concatenate(docs) if docs else np.zeros(0, np.int32)
    sizes = np.bincount(doc, minlength=len(offsets) - 1).astype(np.int64)
    order = np.argsort(tokens, kind="stable").astype(np.int32)
    ranked = tokens[order] >> _TOP
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    del ranked
    group = np.empty(len(tokens), np.int32)
    group[order] = np.cumsum(new, dtype=np.int32) - 1
    prints, checks = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        prints[some] = mixed(np.add.reduceat(mixed(tokens), starts))
        checks[some] = np.add.reduceat(mixed(~tokens), starts)
    part = int(table.column("part")[0].as_py())
    keys = table.column("key").to_numpy()
    return Sets(part, keys, sizes, tokens, doc, order, group, np.flatnonzero(new), prints, checks)


def _token_counts(words: int, percent: int, buckets: int):
    """How many documents have each token, by its leading 48 bits, and the first document of each set."""

    def sender(table: pa.Table, got: pa.Table | None):
        own = _sets(table, words)
        keys = own.tokens[own.order[own.firsts]] >> _TOP
        counts = np.minimum(np.diff(np.append(own.firsts, len(own.order))), 255).astype(np.uint8)
        edges = np.array([(b << 48) // buckets for b in range(1, buckets)], np.uint64)
        cuts = [0, *np.searchsorted(keys, edges), len(keys)]
        for bucket in range(buckets):
            a, b = cuts[bucket], cuts[bucket + 1]
            if b > a:
                yield bucket, own.part, COUNTS, _six_bytes(keys[a:b]), counts[a:b].tobytes()
        some = np.flatnonzero(own.sizes)
        prints, order, first, last = distinct(own.prints[some])
        if len(prints):
            notes = np.empty(len(prints), _SET)
            notes["check"] = own.checks[some][order][first]
            notes["key"] = np.minimum.reduceat(own.keys[some][order], first)
            yield from send(own.part, SETS, prints, notes, buckets)

    def answerer(table: pa.Table):
        yield from _classes(table)
        sent = entries(table, SETS, _SET)
        if len(sent.keys):
            order = np.lexsort((sent.notes["check"], sent.keys))
            keys, checks = sent.keys[order], sent.notes["check"][order]
            new = np.ones(len(order), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
            first = np.flatnonzero(new)
            least = np.minimum.reduceat(sent.notes["key"][order], first)
            notes = np.empty(len(order), np.int64)
            notes[order] = np.repeat(least, np.diff(np.append(first, len(order))))
            yield from answer(sent, SETS, notes < sent.notes["key"], notes)

    return sender, answerer


def _six_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six_bytes(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _classes(table: pa.Table) -> Iterator[tuple]:
    """To each part the magnitude of the count of each token it sent, in the same order; 0 if it is alone."""
    kinds, parts = table.column("kind").to_pylist(), table.column("part").to_pylist()
    rows = [i for i, kind in enumerate(kinds) if kind == COUNTS]
    if not rows:
        return
    keys = [_from_six_bytes(table.column("keys")[i].as_py()) for i in rows]
    counts = np.concatenate([np.frombuffer(table.column("notes")[i].as_py(), np.uint8) for i in rows])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    total = np.add.reduceat(counts[order].astype(np.int64), first)
    out = np.empty(len(order), np.uint8)
    out[order] = np.repeat(np.log2(total).astype(np.uint8), np.diff(np.append(first, len(order))))
    cuts = np.cumsum([0, *(len(k) for k in keys)])
    for n, i in enumerate(rows):
        # a count of one shows that a token can't be shared; the first key tells where the answer belongs
        yield parts[i], COUNTS, keys[n][:1].tobytes(), out[cuts[n] : cuts[n + 1]].tobytes()


def _placed(own: Sets, got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The magnitude of each token's count, and the first document of each document's set."""
    kinds = got.column("kind").to_pylist()
    rows = [i for i, kind in enumerate(kinds) if kind == COUNTS]
    rows.sort(key=lambda i: int.from_bytes(got.column("keys")[i].as_py(), "little"))
    classes = np.concatenate(
        [np.frombuffer(got.column("notes")[i].as_py(), np.uint8) for i in rows] or [np.zeros(0, np.uint8)]
    )
    first = own.keys.copy()
    some = np.flatnonzero(own.sizes)
    if len(some):  # the first within the part, unless another part has an earlier one
        _, order, begin, end = distinct(own.prints[some])
        first[some[order]] = np.repeat(np.minimum.reduceat(own.keys[some][order], begin), end - begin)
        sets = entries(got, SETS, np.dtype(np.int64))
        place = np.argsort(sets.keys, kind="stable")
        known, earlier = sets.keys[place], sets.notes[place]
        if len(known):
            at = np.minimum(np.searchsorted(known, own.prints), len(known) - 1)
            first = np.where((known[at] == own.prints) & (own.sizes > 0), earlier[at], first)
    return classes[own.group], first


def _prefixes(own: Sets, classes: np.ndarray, first: np.ndarray, percent: int) -> np.ndarray:
    """Places of the tokens that a similar set must share one of, for the first row of each distinct set."""
    order = np.lexsort((own.tokens, classes, own.doc)).astype(np.int32)
    starts = (np.cumsum(own.sizes) - own.sizes).astype(np.int32)
    rank = np.arange(len(order), dtype=np.int32) - np.repeat(starts, own.sizes)
    length = own.sizes + (-percent * own.sizes) // 100 + 1
    leads = np.zeros(len(own.sizes), bool)
    here = np.flatnonzero((first == own.keys) & (own.sizes > 0))
    _, lead = np.unique(np.stack([own.keys[here].view(np.uint64), own.prints[here]]), axis=1, return_index=True)
    leads[here[lead]] = True
    doc = own.doc[order]
    return order[(rank < length[doc]) & leads[doc] & (classes[order] > 0)]


def _pivots(words: int, percent: int, buckets: int):
    """The smallest document with each prefix token, and how many there are; sizes and first documents pass through."""

    def sender(table: pa.Table, got: pa.Table):
        own = _sets(table, words)
        classes, first = _placed(own, got)
        notes = np.stack([first, own.sizes])
        yield own.part % buckets, own.part, MEMBERS, own.keys.tobytes(), notes.tobytes()
        chosen = _prefixes(own, classes, first, percent)
        keys, order, begin, end = distinct(own.tokens[chosen])
        if len(keys):
            pivot = np.empty(len(keys), _PIVOT)
            pivot["key"] = np.minimum.reduceat(own.keys[own.doc[chosen]][order], begin)
            pivot["docs"] = end - begin
            yield from send(own.part, PIVOTS, keys, pivot, buckets)

    def answerer(table: pa.Table):
        for row in table.select(["part", "kind", "keys", "notes"]).to_pylist():
            if row["kind"] == MEMBERS:
                yield row["part"], MEMBERS, row["keys"], row["notes"]
        sent = entries(table, PIVOTS, _PIVOT)
        _, order, first, last = distinct(sent.keys)
        if len(first):
            notes = np.empty(len(order), _PIVOT)
            for name, total in (
                ("key", np.minimum.reduceat(sent.notes["key"][order], first)),
                ("docs", np.add.reduceat(sent.notes["docs"][order], first)),
            ):
                notes[name][order] = np.repeat(total, last - first)
            yield from answer(sent, PIVOTS, notes["docs"] > 1, notes)

    return sender, answerer


def _bins(words: int, percent: int, buckets: int):
    """Sends each set to the bins, or crowds, of its prefix tokens."""

    def sender(table: pa.Table, got: pa.Table):
        for row in got.to_pylist():
            if row["kind"] == MEMBERS:
                yield row["part"] % buckets, row["part"], MEMBERS, row["keys"], row["notes"]
        if not len(table):
            return
        own = _sets(table, words)
        classes, first = _placed(own, got)
        chosen = _prefixes(own, classes, first, percent)
        pivots = entries(got, PIVOTS, _PIVOT)
        place = np.argsort(pivots.keys, kind="stable")
        known, notes = pivots.keys[place], pivots.notes[place]
        if not len(known) or not len(chosen):
            return
        at = np.minimum(np.searchsorted(known, own.tokens[chosen]), len(known) - 1)
        met = known[at] == own.tokens[chosen]
        note, doc = notes[at[met]], own.doc[chosen[met]]
        starts = np.cumsum(own.sizes) - own.sizes
        for kind, which in ((BINS, note["docs"] <= HOT), (CROWDS, note["docs"] > HOT)):
            pairs = np.unique(np.stack([note["key"][which], doc[which]]), axis=1)
            bucket = mixed(pairs[0].view(np.uint64)) % np.uint64(buckets)
            if kind == CROWDS:
                bucket = mixed(own.keys[pairs[1]].view(np.uint64)) % np.uint64(buckets)
            for b in np.unique(bucket):
                mine = pairs[:, bucket == b]
                heads = np.empty(mine.shape[1], _HEAD)
                sets = []
                for n, d in enumerate(mine[1]):
                    span = slice(starts[d], starts[d] + own.sizes[d])
                    sets.append(own.tokens[span][classes[span] > 0])
                    heads[n] = mine[0, n], own.keys[d], own.sizes[d], len(sets[-1])
                yield int(b), own.part, kind, heads.tobytes(), np.concatenate(sets).tobytes()

    return sender


def _rows(kind: int, a, b, n=None, tokens=None) -> pa.Table:
    a = np.asarray(a, np.int64)
    return pa.table(
        [
            pa.array(np.full(len(a), kind, np.int32)),
            pa.array(a),
            pa.array(np.asarray(b, np.int64)),
            pa.array(np.asarray(n if n is not None else np.zeros(len(a)), np.int64)),
            pa.array(tokens if tokens is not None else [None] * len(a), pa.binary()),
        ],
        schema=_ROWS_ARROW,
    )


def _joined(percent: int):
    """Members, edges found in bins, and the sets of crowds."""

    def run(table: pa.Table) -> pa.Table:
        out = [_ROWS_ARROW.empty_table()]
        heads, sets = [], []
        rows = sorted(
            table.select(["part", "kind", "keys", "notes"]).to_pylist(), key=lambda r: (r["kind"], r["part"])
        )
        for row in rows:
            if row["kind"] == MEMBERS:
                first, size = np.frombuffer(row["notes"], np.int64).reshape(2, -1)
                out.append(_rows(_MEMBER, np.frombuffer(row["keys"], np.int64), first, size))
                continue
            head = np.frombuffer(row["keys"], _HEAD)
            own = np.split(np.frombuffer(row["notes"], np.uint64), np.cumsum(head["sent"])[:-1])
            if row["kind"] == CROWDS:
                out.append(_rows(_CROWD, head["bin"], head["key"], head["size"], [s.tobytes() for s in own]))
            else:
                heads.append(head)
                sets.extend(own)
        if heads:
            head = np.concatenate(heads)
            order = np.lexsort((head["key"], head["bin"]))
            for members in np.split(order, np.flatnonzero(np.diff(head["bin"][order])) + 1):
                if len(members) > 1:
                    tree = PrefixTree([sets[m] for m in members], head["size"][members].tolist(), percent)
                    others, first = tree.stars()
                    out.append(_rows(_EDGE, head["key"][members[others]], head["key"][members[first]]))
        return pa.concat_tables(out)

    return run


# --- crowds ------------------------------------------------------------------------------


def _crowd_edges(crowds: DataFrame, percent: int) -> DataFrame:
    """Edges among the members of tokens that very many documents have.

    Each member is compared with the pivot.  A pair of members both similar to
    it is connected already.  The others are sent to every block of the crowd,
    which a hash of the id forms, and looked up in a prefix tree of the block.
    """
    pivots = crowds.filter(F.col("pivot") == F.col("key")).select(
        "pivot", F.col("n").alias("pivot_n"), F.col("tokens").alias("pivot_tokens")
    )
    compared = stored(
        crowds.join(stored(pivots.dropDuplicates(["pivot"]), "pivots"), "pivot")
        .select("pivot", "key", "n", "tokens", "pivot_n", "pivot_tokens")
        .mapInArrow(_near_pivot(percent), "pivot long, key long, n long, tokens binary, near boolean"),
        "crowds",
    )
    blocks_of = crowds.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).cast("int").alias("blocks"))
    blocks_of = stored(blocks_of, "blocks")
    placed = compared.join(blocks_of, "pivot").select(
        "pivot", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"), "key", "n", "tokens", F.lit(False).alias("asked")
    )
    asked = (
        compared.filter(~F.col("near"))
        .join(blocks_of, "pivot")
        .select(
            "pivot",
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            "key",
            "n",
            "tokens",
            F.lit(True).alias("asked"),
        )
    )
    among_blocks = placed.unionAll(asked).groupBy("pivot", "block").applyInArrow(_look_up(percent), "a long, b long")
    return compared.filter("near AND pivot <> key").select("pivot", "key").unionAll(among_blocks)


def _near_pivot(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for n, tokens, pivot_n, pivot_tokens in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True):
                own, other = np.frombuffer(tokens, np.uint64), np.frombuffer(pivot_tokens, np.uint64)
                shared = len(np.intersect1d(own, other, assume_unique=True))
                near.append((100 + percent) * shared >= percent * (n + pivot_n))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(near, pa.bool_())], ["pivot", "key", "n", "tokens", "near"]
            )

    return run


def _look_up(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        keys, asked = table.column("key").to_numpy(), table.column("asked").to_numpy(zero_copy_only=False)
        if not asked.any():
            return schema.empty_table()
        table = table.take(pa.array(np.lexsort((asked, keys))))
        keys, asked = table.column("key").to_numpy(), table.column("asked").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
        tree = PrefixTree(sets, table.column("n").to_pylist(), percent)
        others, first = tree.stars(np.flatnonzero(asked).tolist())
        real = keys[others] != keys[first]
        return pa.table([pa.array(keys[others[real]]), pa.array(keys[first[real]])], schema=schema)

    return run
