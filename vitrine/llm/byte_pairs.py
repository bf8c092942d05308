"""Byte-level BPE: texts to token ids and back.

Each piece the pattern matches is looked up as a whole first, by a minimal
perfect hash over the vocabulary.  Only the pieces that are no token are merged
pair by pair, with a heap over linked bytes: short ones many at a time, each
with a heap of its own, long ones one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm.words import BYTE_VALUES, POWERS, blocks, mixed, text_bytes

BLOCK = 1 << 20
PART_CHARS = 1 << 18  # a longer text is matched in parts
WIDTHS = (8, 16, 32)  # bytes of the pieces that are merged side by side
ROWS = 1 << 12
REMEMBERED = 1 << 18  # pieces a task keeps, about 50 MB
_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, from a file of lines ``base64 rank``."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    found = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(found) != list(range(len(pairs))) or len(set(found.values())) != len(pairs):
        raise ValueError("ranks must count from 0 without gaps, each with a token of its own")
    return [found[rank] for rank in range(len(pairs))]


class Strings:
    """Bytes, and the fingerprint of any stretch of them."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        up, self._down = POWERS.upto(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=self._sums[1:])

    def prints(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts])


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The strings of ``data`` at ``starts``, one behind the other."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places))
    return data[places]


@dataclass
class Vocabulary:
    """Tokens by rank, and a minimal perfect hash that finds a token's rank by its bytes.

    A fingerprint picks one of as many displacements as there are tokens; a
    displacement of 0 or more is hashed with the fingerprint into a slot, a
    negative one names the slot itself.  Each slot holds one rank.
    """

    data: np.ndarray
    offsets: np.ndarray
    displacements: np.ndarray
    slots: np.ndarray

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.offsets[ids + 1] - self.offsets[ids]

    def find(self, strings: Strings, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rank of each stretch, -1 for those that are no token; told by the bytes, not the hash alone."""
        prints = strings.prints(starts, ends)
        moved = self.displacements[prints % np.uint64(len(self.slots))]
        ids = self.slots[np.where(moved < 0, -moved - 1, _slot(prints, np.maximum(moved, 0), len(self.slots)))]
        sizes = ends - starts
        ids[self.sizes(ids) != sizes] = -1
        some = np.flatnonzero(ids >= 0)
        mine = gathered(strings.data, starts[some], sizes[some])
        theirs = gathered(self.data, self.offsets[ids[some]], sizes[some])
        ids[np.repeat(some, sizes[some])[mine != theirs]] = -1
        return ids

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.data, self.offsets[ids], self.sizes(ids))


def _slot(prints: np.ndarray, displacement, count: int) -> np.ndarray:
    salted = prints ^ (np.atleast_1d(displacement).astype(np.uint64) + np.uint64(1)) * _STEP
    return (mixed(salted) % np.uint64(count)).astype(np.int64)


def build_vocabulary(tokens: list[bytes]) -> Vocabulary:
    """Hash and displace: the buckets with most tokens look for free slots first, single ones take what is left."""
    data = np.frombuffer(b"".join(tokens), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
    count = len(tokens)
    prints = Strings(data).prints(offsets[:-1], offsets[1:])
    if len(np.unique(prints)) != count:
        raise ValueError("two tokens have the same fingerprint")
    bucket = (prints % np.uint64(count)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    held, first, size = np.unique(bucket[order], return_index=True, return_counts=True)
    displacements = np.zeros(count, np.int32)
    slots = np.full(count, -1, np.int32)
    for k in np.argsort(-size, kind="stable"):
        members = order[first[k] : first[k] + size[k]]
        if size[k] == 1:
            break
        displacement = 0
        while True:
            places = _slot(prints[members], displacement, count)
            if (slots[places] < 0).all() and len(set(places.tolist())) == len(places):
                break
            displacement += 1
        slots[places] = members
        displacements[held[k]] = displacement
    single = size == 1
    free = np.flatnonzero(slots < 0)
    slots[free] = order[first[single]]
    displacements[held[single]] = -free - 1
    return Vocabulary(data, offsets, displacements, slots)


def merge(piece: bytes, ranks: dict[bytes, int], couples: np.ndarray) -> list[int]:
    """Token ids of a piece: the pair of least rank, leftmost among equals, is merged until no pair is a token.

    A symbol is named by its first byte's place, ``after`` by where it ends.
    The heap holds a pair's rank and place in one number; an entry whose pair
    has another rank by now is passed over.  ``couples`` has the ranks of all
    strings of two bytes.
    """
    size, none = len(piece), len(ranks)
    after = list(range(1, size + 1))
    before = list(range(-1, size))
    raw = np.frombuffer(piece, np.uint8).astype(np.int64)
    pair = couples[raw[:-1] << 8 | raw[1:]].tolist()
    heap = [rank << 32 | i for i, rank in enumerate(pair) if rank < none]
    pair.append(none)
    after.append(size)
    heapify(heap)
    while heap:
        least = heappop(heap)
        i = least & 0xFFFFFFFF
        if pair[i] != least >> 32:
            continue
        gone = after[i]
        end = after[i] = after[gone]
        pair[gone] = none
        before[end] = i
        if end < size:
            rank = pair[i] = ranks.get(piece[i : after[end]], none)
            if rank < none:
                heappush(heap, rank << 32 | i)
        else:
            pair[i] = none
        left = before[i]
        if left >= 0:
            rank = pair[left] = ranks.get(piece[left:end], none)
            if rank < none:
                heappush(heap, rank << 32 | left)
    out, i = [], 0
    while i < size:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


def merge_side_by_side(
    strings: Strings, starts: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary, couples: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids, and how many each piece has: ``merge`` for many pieces of at most ``width`` bytes, a merge of each at a time.

    A piece's heap is a row: leaf width + i holds rank * width + i of the pair
    at place i, every inner node the lesser of its two children.
    """
    count, none = len(starts), len(vocabulary.slots) * width
    place = np.arange(width)
    alive = place < sizes[:, None]
    after = np.minimum(np.arange(1, width + 2), sizes[:, None])
    before = np.tile(np.arange(-1, width), (count, 1))
    heap = np.full((count, 2 * width), none, np.int64)
    row, i = np.nonzero(place + 1 < sizes[:, None])
    at = starts[row] + i
    heap[row, width + i] = couples[strings.data[at].astype(np.int64) << 8 | strings.data[at + 1]] * width + i
    np.minimum(heap, none, out=heap)
    for node in range(width - 1, 0, -1):
        np.minimum(heap[:, 2 * node], heap[:, 2 * node + 1], out=heap[:, node])
    rows = np.arange(count)
    while True:
        least = heap[rows, 1]
        rows, least = rows[least < none], least[least < none]
        if not len(rows):
            break
        i = least % width
        gone = after[rows, i]
        end = after[rows, gone]
        after[rows, i] = end
        before[rows, end] = i
        alive[rows, gone] = False
        left = before[rows, i]
        right, some = end < sizes[rows], left >= 0
        new_rows = np.concatenate((rows[right], rows[some]))
        new = np.concatenate((i[right], left[some]))
        ends = np.concatenate((after[rows[right], end[right]], end[some]))
        ranks = vocabulary.find(strings, starts[new_rows] + new, starts[new_rows] + ends)
        changed = np.concatenate((rows, rows, new_rows))
        node = width + np.concatenate((gone, i, new))
        heap[rows, width + gone] = heap[rows, width + i] = none
        heap[new_rows, width + new] = np.where(ranks < 0, none, ranks.astype(np.int64) * width + new)
        for _ in range(width.bit_length() - 1):
            node >>= 1
            heap[changed, node] = np.minimum(heap[changed, 2 * node], heap[changed, 2 * node + 1])
    row, i = np.nonzero(alive)
    return vocabulary.find(strings, starts[row] + i, starts[row] + after[row, i]), alive.sum(axis=1)


def _pieces(matcher, breaks, text: str) -> list[str]:
    """All matches; a long text is matched in parts that end between a character and a white space behind it.

    No match of the byte-level patterns goes on over such a place or looks
    across it, since white space stands only at the beginning of a match.
    """
    if len(text) <= PART_CHARS:
        return matcher.findall(text)
    out, start = [], 0
    while start < len(text):
        found = breaks.search(text, start + PART_CHARS)
        end = found.start() + 1 if found else len(text)
        out += matcher.findall(text[start:end])
        start = end
    return out


class Encoder:
    """A task's encoder: the vocabulary, and the pieces it has met lately with their ids."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, remembered: int = REMEMBERED) -> None:
        import regex

        self.vocabulary, self.remembered = vocabulary, remembered
        self.matcher, self.breaks = regex.compile(pattern), regex.compile(r"\S\s")
        data, bounds = vocabulary.data.tobytes(), vocabulary.offsets.tolist()
        self.ranks = {data[a:b]: i for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))}
        none = len(self.ranks)
        self.couples = np.array([self.ranks.get(bytes((i >> 8, i & 255)), none) for i in range(1 << 16)], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Looks all pieces up, and merges those that are no token."""
        data, offsets = text_bytes(pa.array(pieces, pa.large_string()))
        strings, lengths = Strings(data), np.diff(offsets)
        whole = self.vocabulary.find(strings, offsets[:-1], offsets[1:])
        sizes = np.ones(len(whole), np.int64)
        missing, least = whole < 0, 0
        order, flat = [np.flatnonzero(~missing)], [whole[~missing]]
        for width in WIDTHS:
            some = np.flatnonzero(missing & (lengths > least) & (lengths <= width))
            least = width
            for k in range(0, len(some), ROWS):
                own = some[k : k + ROWS]
                ids, sizes[own] = merge_side_by_side(strings, offsets[own], lengths[own], self.vocabulary, self.couples, width)
                order.append(own)
                flat.append(ids)
        raw, rest = data.tobytes(), np.flatnonzero(missing & (lengths > least))
        for k in rest.tolist():
            flat.append(merge(raw[offsets[k] : offsets[k + 1]], self.ranks, self.couples))
            sizes[k] = len(flat[-1])
        learned = np.concatenate((*order, rest))
        self.known.update(zip([pieces[k] for k in learned.tolist()], range(len(self.known), len(self.known) + len(pieces)), strict=True))
        sizes, flat = sizes[learned], np.concatenate(flat).astype(np.int32)
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes)))
        self.flat = np.concatenate((self.flat, flat))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and how many each text has."""
        pieces, counts = [], []
        for text in texts:
            own = _pieces(self.matcher, self.breaks, text)
            pieces += own
            counts.append(len(own))
        if len(self.known) > self.remembered:
            self._forget()
        rows = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(rows < 0).tolist()
        if new:
            self._learn(list(dict.fromkeys(pieces[k] for k in new)))
            rows[new] = [self.known[pieces[k]] for k in new]
        sizes = self.starts[rows + 1] - self.starts[rows]
        flat = gathered(self.flat, self.starts[rows], sizes)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0, *counts])]
        return flat, np.diff(ends)


def _sent(df: DataFrame, ranks_path: str):
    """The vocabulary's arrays for all tasks; its class is not sent along, executors may lack this package."""
    found = build_vocabulary(read_ranks(ranks_path))
    return df.sparkSession.sparkContext.broadcast((found.data, found.offsets, found.displacements, found.slots))


def encode(docs: DataFrame, ranks_path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """Token ids of each row of ``docs`` (doc_id, text; other columns are not read).

    Returns doc_id, ids and n_tokens, with ``decoded`` also the bytes the ids
    stand for.  Strings of special tokens are ordinary text.  ``pattern`` is
    one of the byte-level patterns, whose matches hold white space at their
    beginning only; what it doesn't match has no tokens.

    A null or empty text has no ids.  Repeated rows are encoded alike; an empty
    table gives an empty result.  Equal ranks of several pairs are merged from
    the left.  The vocabulary is bounded by its file and sent to the tasks as a
    whole; texts are handled in blocks of about a megabyte, a longer one alone.
    """
    shared = _sent(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            _, offsets = text_bytes(texts)
            for a, b in blocks(offsets, BLOCK):
                flat, counts = encoder.encode(texts.slice(a, b - a).to_pylist())
                cuts = np.concatenate(([0], np.cumsum(counts)))
                columns = [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat)),
                    pa.array(counts, pa.int64()),
                ]
                if decoded:
                    columns.append(_decoded(vocabulary, flat, cuts))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_tokens", "decoded"][: len(columns)])

    kind = "doc_id long, ids array<int>, n_tokens long" + (", decoded binary" if decoded else "")
    return docs.select("doc_id", "text").mapInArrow(run, kind)


def _decoded(vocabulary: Vocabulary, flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of each run flat[cuts[i]:cuts[i+1]] of ids."""
    ends = np.concatenate(([0], np.cumsum(vocabulary.sizes(flat))))[cuts]
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(vocabulary.decode(flat))]
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, buffers)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the bytes of rows with doc_id and ids; null ids, and a list without any, give no bytes."""
    shared = _sent(encoded, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.array(ids or [], np.int32) for ids in batch.column(1).to_pylist()]
            cuts = np.concatenate(([0], np.cumsum([len(ids) for ids in own]))).astype(np.int64)
            flat = np.concatenate([np.zeros(0, np.int32), *own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), _decoded(Vocabulary(*shared.value), flat, cuts)], ["doc_id", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
