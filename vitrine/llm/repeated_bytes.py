"""Removal of byte strings that occur more than once anywhere, found by suffix sorting.

Each window of ``length`` bytes has an anchor, the least gram in it; windows in
a row with the same anchor form a segment.  Equal windows have equal anchors.

* Anchors are counted over all parts.  A segment whose anchor occurs once has
  no repeat; if all segments of an anchor are equal, all of them are repeats.
* Of the other anchors, equal segments are repeats of each other.
* The bytes of their distinct segments are sent, by anchor, to be sorted as
  suffixes (see ``suffixes``); windows next to an equal one are repeats.

An anchor with more than HOT windows in its different segments (those of each
part added up) isn't sorted in one place: the windows of its segments are asked
about one by one, spread by their own hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vitrine.llm.exchange import among, answer, ask, buckets_of, dealt, distinct, entries, finish, send
from vitrine.llm.suffixes import Suffixes
from vitrine.llm.words import BYTE_VALUES, POWERS, blocks, covered, mixed, text_bytes

HOT = 1 << 15
SORT_BYTES = 1 << 19
SORT_WINDOWS = 1 << 16
_RESULT = (
    T.StructType()
    .add("doc_id", "long")
    .add("n_bytes", "long")
    .add("n_removed", "long")
    .add("n_spans", "long")
)
ANCHORS, SEGMENTS, SPANS, WINDOWS = range(4)
_UNIFORM, _MIXED, _HOT = 1, 2, 3
_REPEATED, _SINGLE, _SENDER = 1, 2, 3
_ANCHOR = np.dtype([("print", np.uint64), ("check", np.uint32), ("kinds", np.uint32), ("windows", np.uint32), ("several", np.uint8)])
_COUNT = np.dtype([("check", np.uint32), ("several", np.uint8)])
_SEGMENT = np.dtype(
    [
        ("anchor", np.uint64),
        ("print", np.uint64),
        ("check", np.uint32),
        ("count", np.uint32),
        ("at", np.uint32),
        ("single", np.uint32),
    ]
)
_SPAN = np.dtype([("check", np.uint32), ("first", np.uint32), ("last", np.uint32)])
_PLACE = np.uint64((1 << 23) - 1)
_PIECE = 1 << 22
_CHECK_VALUES = mixed(BYTE_VALUES + np.uint64(1)) | np.uint64(1)


def remove_repeated_bytes(
    docs: DataFrame, length: int = 200, gram: int = 64, as_text: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Removes each byte in a string of ``length`` bytes that also starts at another place of any document.

    ``docs`` needs doc_id and text; other columns are not read.  Texts are
    judged as UTF-8 bytes on the input, in whole; overlapping occurrences count,
    those in the same document too.  Returns per row doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs) and kept, the remaining bytes in order.  They
    need not be whole characters at the cuts; ``as_text`` gives them as a string
    without what is left of characters that were cut.  The columns in ``carry``
    follow.

    A null text counts as empty; it and texts shorter than ``length`` keep all.
    Repeated rows repeat each other, whatever their doc_id.  An empty table
    gives an empty result.

    Segments and windows are compared by 96 bits of two hashes, suffixes byte by
    byte.
    """
    if length < 8 or gram > length:
        raise ValueError("length must be 8 at least and gram no more than length")
    buckets = buckets_of(docs)
    dealt_docs = dealt(docs, "doc_id", "text", *carry)
    answers = None
    for sender, answerer in (
        _anchors(length, gram, buckets),
        _segments(length, gram, buckets),
        _suffixes(length, gram, buckets),
    ):
        got = ask(dealt_docs, answers, sender, answerer)
        answers = got if answers is None else answers.unionAll(got)
    kept = T.StructField("kept", T.StringType() if as_text else T.BinaryType())
    schema = T.StructType([*_RESULT.fields, kept, *(docs.schema[c] for c in carry)])
    return finish(dealt_docs, answers, _removal(length, gram, carry, to_arrow_schema(schema)), schema)


@dataclass
class Segments:
    """Segments of a part: anchor, first and last window (byte places), place of the anchor, two hashes."""

    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    print: np.ndarray
    check: np.ndarray

    def take(self, chosen: np.ndarray) -> Segments:
        return Segments(*(getattr(self, f)[chosen] for f in ("anchor", "first", "last", "at", "print", "check")))


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where a piece of the bytes starts, and the bounds of its texts; long texts come in overlapping pieces."""
    for a, b in blocks(offsets):
        start, end = int(offsets[a]), int(offsets[b])
        if b - a == 1 and end - start > _PIECE:
            for at in range(start, max(start + 1, end - length + 1), _PIECE):
                yield at, np.array([0, min(end, at + _PIECE + length - 1) - at])
        else:
            yield start, offsets[a : b + 1] - start


def _least_of(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` consecutive values, by running minima from both ends of chunks."""
    count = len(values) - span + 1
    padded = np.full(-(-len(values) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    chunks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(chunks, axis=1).ravel()
    behind = np.minimum.accumulate(chunks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[span - 1 : span - 1 + count])


def _sums(values: np.ndarray, piece: np.ndarray) -> np.ndarray:
    up, _ = POWERS.upto(len(piece) + 1)
    out = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum(values[piece] * up[: len(piece)], out=out[1:])
    return out


def segments_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Segments:
    """All segments of a part's texts."""
    found = []
    for start, cuts in _pieces(offsets, length):
        piece = data[start : start + cuts[-1]]
        size = len(piece)
        if size < length:
            continue
        sums = _sums(BYTE_VALUES, piece)
        _, down = POWERS.upto(size + 1)
        grams = mixed((sums[gram:] - sums[:-gram]) * down[: size - gram + 1])
        # the leftmost of the least: the place takes the low bits
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        at = (_least_of(ranked, length - gram + 1) & _PLACE).astype(np.int64)
        ends = np.repeat(cuts[1:], np.diff(cuts))[: len(at)]
        whole = np.arange(length, length + len(at)) <= ends
        follows = whole[1:] & whole[:-1] & (at[1:] == at[:-1])
        first = np.flatnonzero(whole & ~np.concatenate(([False], follows)))
        last = np.flatnonzero(whole & ~np.concatenate((follows, [False])))
        if not len(first):
            continue
        end = last + length
        shape = ((end - first) << 32 | (at[first] - first)).astype(np.uint64)
        prints = mixed(mixed((sums[end] - sums[first]) * down[first]) ^ shape)
        others = _sums(_CHECK_VALUES, piece)
        checks = (mixed((others[end] - others[first]) * down[first]) >> np.uint64(32)).astype(np.uint32)
        # mixed once more: the least of many hashes are small, and buckets are ranges of equal width
        found.append((mixed(grams[at[first]]), first + start, last + start, at[first] + start, prints, checks))
    if not found:
        empty = np.zeros(0, np.int64)
        return Segments(empty.astype(np.uint64), empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint32))
    return Segments(*(np.concatenate(c) for c in zip(*found, strict=True)))


def _part(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(table.column("text"))
    return int(table.column("part")[0].as_py()), data, offsets


def _noted(table: pa.Table, kind: int, notes: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Answered keys and their notes, sorted by key."""
    got = entries(table, kind, notes)
    order = np.argsort(got.keys, kind="stable")
    return got.keys[order], got.notes[order]


def _note(values: np.ndarray, keys: np.ndarray, notes: np.ndarray) -> np.ndarray:
    """The note of each value, 0 where the key is unknown."""
    if not len(keys):
        return np.zeros(len(values), np.uint8)
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[place] == values, notes[place], 0)


def _anchors(length: int, gram: int, buckets: int):
    """Which anchors occur more than once, and whether all their segments are equal."""

    def sender(table: pa.Table, got: pa.Table | None):
        part, data, offsets = _part(table)
        own = segments_of(data, offsets, length, gram)
        if not len(own.anchor):
            return
        order = np.lexsort((own.check, own.print, own.anchor))
        anchor, prints, checks = own.anchor[order], own.print[order], own.check[order]
        new = np.ones(len(order), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        other = new.copy()
        other[1:] |= (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])
        first = np.flatnonzero(new)
        notes = np.empty(len(first), _ANCHOR)
        notes["print"], notes["check"] = prints[first], checks[first]
        notes["kinds"] = np.add.reduceat(other, first, dtype=np.int64)
        windows = np.where(other, own.last[order] - own.first[order] + 1, 0)
        notes["windows"] = np.minimum(np.add.reduceat(windows, first), np.iinfo(np.uint32).max)
        notes["several"] = np.diff(np.append(first, len(order))) > 1
        yield from send(part, ANCHORS, anchor[first], notes, buckets)

    def answerer(table: pa.Table):
        sent = entries(table, ANCHORS, _ANCHOR)
        _, order, first, last = distinct(sent.keys)
        if not len(first):
            return
        notes = sent.notes[order]
        windows = np.add.reduceat(notes["windows"].astype(np.int64), first)
        differs = _differs(first, last, notes["print"], notes["check"])
        differs |= np.maximum.reduceat(notes["kinds"], first) > 1
        verdict = np.where(differs, np.where(windows > HOT, _HOT, _MIXED), _UNIFORM)
        verdict[(last - first < 2) & (np.maximum.reduceat(notes["several"], first) == 0)] = 0
        out = np.empty(len(order), np.uint8)
        out[order] = np.repeat(verdict, last - first)
        yield from answer(sent, ANCHORS, out > 0, out)

    return sender, answerer


def _differs(first: np.ndarray, last: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Whether a group's rows differ from one another in any column."""
    out = np.zeros(len(first), bool)
    for column in columns:
        if len(first):
            out |= np.minimum.reduceat(column, first) != np.maximum.reduceat(column, first)
    return out


def _same_pair(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and check value, and first and last of each group of equal pairs."""
    order = np.lexsort((checks, keys))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    first = np.flatnonzero(new)
    return order, first, np.append(first[1:], len(order))


def _count_pairs(part: int, kind: int, keys: np.ndarray, checks: np.ndarray, buckets: int):
    """Distinct pairs of key and check value, and whether they occur several times in the part."""
    order, first, last = _same_pair(keys, checks)
    notes = np.empty(len(first), _COUNT)
    notes["check"], notes["several"] = checks[order][first], last - first > 1
    yield from send(part, kind, keys[order][first], notes, buckets)


def _counted_pairs(table: pa.Table, kind: int):
    """What a bucket got of a kind, whether each pair occurs more than once, and whether a row is its first."""
    sent = entries(table, kind, _COUNT)
    order, first, last = _same_pair(sent.keys, sent.notes["check"])
    repeated, leads = np.zeros(len(order), bool), np.zeros(len(order), bool)
    if len(first):
        many = (last - first > 1) | (np.maximum.reduceat(sent.notes["several"][order], first) > 0)
        repeated[order] = np.repeat(many, last - first)
        leads[order[first]] = True
    return sent, repeated, leads


def _segments(length: int, gram: int, buckets: int):
    """Of the anchors with different segments: which segments occur more than once, and who sends their bytes."""

    def sender(table: pa.Table, got: pa.Table):
        part, data, offsets = _part(table)
        own = segments_of(data, offsets, length, gram)
        own = own.take(_note(own.anchor, *_noted(got, ANCHORS, np.dtype(np.uint8))) >= _MIXED)
        yield from _count_pairs(part, SEGMENTS, own.print, own.check, buckets)

    def answerer(table: pa.Table):
        sent, repeated, leads = _counted_pairs(table, SEGMENTS)
        notes = np.where(repeated, np.where(leads, _SENDER, _REPEATED), _SINGLE).astype(np.uint8)
        yield from answer(sent, SEGMENTS, notes > 0, notes)

    return sender, answerer


def _suffixes(length: int, gram: int, buckets: int):
    """Which windows of distinct segments equal windows of other segments."""

    def sender(table: pa.Table, got: pa.Table):
        part, data, offsets = _part(table)
        own = segments_of(data, offsets, length, gram)
        role = _note(own.anchor, *_noted(got, ANCHORS, np.dtype(np.uint8)))
        state = _note(own.print, *_noted(got, SEGMENTS, np.dtype(np.uint8)))
        chosen = np.flatnonzero((role >= _MIXED) & (state >= _SINGLE))
        _, unique = np.unique(own.print[chosen], return_index=True)
        chosen = chosen[unique]
        hot = role[chosen] == _HOT
        yield from _send_bytes(part, data, own.take(chosen[~hot]), state[chosen[~hot]], length, buckets)
        if hot.any():
            keys, checks = _windows(data, offsets, own.take(chosen[hot]), length)
            yield from _count_pairs(part, WINDOWS, keys, checks, buckets)

    def answerer(table: pa.Table):
        yield from _sorted_spans(table, length)
        sent, repeated, _ = _counted_pairs(table, WINDOWS)
        yield from answer(sent, WINDOWS, repeated, sent.notes["check"])

    return sender, answerer


def _send_bytes(part: int, data: np.ndarray, own: Segments, state: np.ndarray, length: int, buckets: int):
    """Segments with their bytes, to the bucket of their anchor."""
    order = np.argsort(own.anchor, kind="stable")
    own, state = own.take(order), state[order]
    heads = np.empty(len(order), _SEGMENT)
    heads["anchor"], heads["print"], heads["check"] = own.anchor, own.print, own.check
    heads["count"], heads["at"] = own.last - own.first + 1, own.at - own.first
    heads["single"] = state == _SINGLE
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    cuts = [0, *np.searchsorted(own.anchor, edges), len(order)]
    for bucket in range(buckets):
        a, b = cuts[bucket], cuts[bucket + 1]
        if b > a:
            sizes = own.last[a:b] + length - own.first[a:b]
            yield bucket, part, SPANS, heads[a:b].tobytes(), data[_ranges(own.first[a:b], sizes)].tobytes()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of the ranges, one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _windows(data: np.ndarray, offsets: np.ndarray, own: Segments, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window of the segments."""
    order = np.argsort(own.first, kind="stable")
    own = own.take(order)
    keys, checks = [], []
    for start, cuts in _pieces(offsets, length):
        piece = data[start : start + cuts[-1]]
        a, b = np.searchsorted(own.first, [start, start + max(0, len(piece) - length + 1)])
        if b > a:
            at = _ranges(own.first[a:b], own.last[a:b] - own.first[a:b] + 1) - start
            _, down = POWERS.upto(len(piece) + 1)
            for values, out in ((BYTE_VALUES, keys), (_CHECK_VALUES, checks)):
                sums = _sums(values, piece)
                out.append(mixed((sums[at + length] - sums[at]) * down[at]))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    return np.concatenate(keys), (np.concatenate(checks) >> np.uint64(32)).astype(np.uint32)


def _sorted_spans(table: pa.Table, length: int) -> Iterator[tuple]:
    """Sorts the suffixes of a bucket's segments, about a megabyte of whole anchors at a time."""
    kinds = table.column("kind").to_pylist()
    rows = sorted((i for i, k in enumerate(kinds) if k == SPANS), key=table.column("part").to_pylist().__getitem__)
    if not rows:
        return
    parts = table.column("part").to_pylist()
    heads = [np.frombuffer(table.column("keys")[i].as_py(), _SEGMENT) for i in rows]
    owner = np.repeat(np.arange(len(rows)), [len(h) for h in heads])
    content = np.frombuffer(b"".join(table.column("notes")[i].as_py() for i in rows), np.uint8)
    head = np.concatenate(heads)
    sizes = head["count"].astype(np.int64) + length - 1
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(head["anchor"], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = head["anchor"][order][1:] != head["anchor"][order][:-1]
    group = np.cumsum(new) - 1
    filled = np.cumsum(sizes[order])
    batch = (filled - sizes[order]) // SORT_BYTES
    batch = batch[np.flatnonzero(new)][group]  # an anchor goes with its first segment
    found: dict[int, list[tuple]] = {}
    for chosen in np.split(order, np.flatnonzero(batch[1:] != batch[:-1]) + 1):
        for which, first, last in _repeats(content, head, begin, sizes, chosen, length):
            found.setdefault(int(owner[which]), []).append((int(head["print"][which]), int(head["check"][which]), first, last))
    for row, spans in found.items():
        notes = np.empty(len(spans), _SPAN)
        notes["check"], notes["first"], notes["last"] = (np.array(c) for c in list(zip(*spans, strict=True))[1:])
        keys = np.array([s[0] for s in spans], np.uint64)
        yield parts[rows[row]], SPANS, keys.tobytes(), notes.tobytes()


def _repeats(content, head, begin, sizes, chosen, length) -> Iterator[tuple[int, int, int]]:
    """Segments that occur once, with the first and last of each run of their windows found elsewhere too."""
    size = sizes[chosen]
    suffixes = Suffixes(content[_ranges(begin[chosen], size)], length)
    count = head["count"][chosen].astype(np.int64)
    which = np.repeat(np.arange(len(chosen)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = np.repeat(np.cumsum(size) - size, count) + number
    # only windows with the anchor at the same place can be equal
    anchors = np.unique(head["anchor"][chosen], return_inverse=True)[1]
    group = anchors[which] * (length + 1) + head["at"][chosen].astype(np.int64)[which] - number
    repeated = np.zeros(len(starts), bool)
    by_group = np.argsort(group, kind="stable")
    for some in _chunks(by_group, group[by_group]):
        order = some[suffixes.sort(starts[some], group[some])]
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(group[a] == group[b])
        equal = near[suffixes.equal(starts[a[near]], starts[b[near]])]
        repeated[a[equal]] = repeated[b[equal]] = True
    repeated &= (head["single"][chosen] > 0)[which]
    places = np.flatnonzero(repeated)
    if len(places):
        joins = (which[places[1:]] == which[places[:-1]]) & (places[1:] == places[:-1] + 1)
        first = places[np.concatenate(([True], ~joins))]
        last = places[np.concatenate((~joins, [True]))]
        for w, f, e in zip(which[first].tolist(), number[first].tolist(), number[last].tolist(), strict=True):
            yield int(chosen[w]), f, e


def _chunks(rows: np.ndarray, group: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in order of their group, about SORT_WINDOWS of whole groups at a time, without those alone in theirs."""
    new = np.ones(len(rows), bool)
    new[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(rows)))
    shared = np.repeat(size > 1, size)
    rows, first = rows[shared], np.repeat(first, size)[shared]
    heads = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))) if len(rows) else first
    batch = heads // SORT_WINDOWS
    cuts = heads[1:][batch[1:] != batch[:-1]]
    yield from np.split(rows, cuts) if len(rows) else []


def _removal(length: int, gram: int, carry: tuple[str, ...], schema: pa.Schema):
    def last(table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            return schema.empty_table()
        _, data, offsets = _part(table)
        own = segments_of(data, offsets, length, gram)
        role = _note(own.anchor, *_noted(got, ANCHORS, np.dtype(np.uint8)))
        state = _note(own.print, *_noted(got, SEGMENTS, np.dtype(np.uint8)))
        mixed_up = role >= _MIXED
        full = (role == _UNIFORM) | (mixed_up & ((state == _REPEATED) | (state == _SENDER)))
        starts, ends = [own.first[full]], [own.last[full] + length]
        single = own.take(np.flatnonzero((role == _MIXED) & (state == _SINGLE)))
        for which, span in _span_rows(single, *_noted(got, SPANS, _SPAN)):
            starts.append(single.first[which] + span["first"])
            ends.append(single.first[which] + span["last"] + length)
        hot = own.take(np.flatnonzero((role == _HOT) & (state == _SINGLE)))
        if len(hot.first):
            hot = hot.take(np.argsort(hot.first, kind="stable"))
            keys, checks = _windows(data, offsets, hot, length)
            known, noted = _noted(got, WINDOWS, np.dtype(np.uint32))
            order = np.lexsort((noted, known))
            hit = _pair_among(keys, checks, known[order], noted[order])
            at = _ranges(hot.first, hot.last - hot.first + 1)[hit]
            starts.append(at)
            ends.append(at + length)
        begin, end = np.concatenate(starts), np.concatenate(ends)
        gone = covered(begin, end - begin, len(data))
        columns = _kept(table, data, offsets, gone)
        if pa.types.is_string(schema.field("kept").type):
            columns[-1] = pa.array([kept.decode("utf-8", "ignore") for kept in columns[-1].to_pylist()], pa.string())
        columns += [table.column(c).cast(schema.field(c).type) for c in carry]
        return pa.table(columns, schema=schema)

    return last


def _span_rows(own: Segments, keys: np.ndarray, notes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of segments and one of their spans each, until all spans are dealt with."""
    low = np.searchsorted(keys, own.print)
    high = np.searchsorted(keys, own.print, side="right")
    which = np.arange(len(own.print))
    while True:
        which = which[low[which] < high[which]]
        if not len(which):
            return
        span = notes[low[which]]
        fits = span["check"] == own.check[which]
        yield which[fits], span[fits]
        low[which] += 1


def _pair_among(keys: np.ndarray, checks: np.ndarray, known: np.ndarray, noted: np.ndarray) -> np.ndarray:
    """Which pairs occur among sorted pairs; equal keys with different check values are as good as unheard of."""
    hit = among(keys, known)
    at = np.flatnonzero(hit)
    low, high = np.searchsorted(known, keys[at]), np.searchsorted(known, keys[at], side="right")
    fits = np.zeros(len(at), bool)
    while (low < high).any():
        fits |= (low < high) & (noted[np.minimum(low, len(known) - 1)] == checks[at])
        low = low + 1
    hit[at] = fits
    return hit


def _counted_before(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many flags are set before each of the ascending places."""
    pieces = [np.count_nonzero(flags[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
    return np.concatenate(([0], np.cumsum(pieces, dtype=np.int64)))


def _kept(table: pa.Table, data: np.ndarray, offsets: np.ndarray, gone: np.ndarray) -> list:
    """The result columns of a part, given its removed bytes."""
    removed = _counted_before(gone, offsets)
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(gone)]
    opens[cuts] = gone[cuts]
    spans = _counted_before(opens, offsets)
    kept = (offsets - removed).astype(np.int32)
    content = pa.BinaryArray.from_buffers(
        pa.binary(), len(table), [None, pa.py_buffer(kept), pa.py_buffer(data[~gone])]
    )
    return [
        table.column("doc_id").cast(pa.int64()),
        pa.array(np.diff(offsets), pa.int64()),
        pa.array(np.diff(removed), pa.int64()),
        pa.array(np.diff(spans), pa.int64()),
        content,
    ]
