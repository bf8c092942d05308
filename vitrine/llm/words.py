"""Words and word windows of Arrow text columns, as numpy arrays.

Texts are handled as the UTF-8 bytes Arrow already holds.  A word is a maximal
run of word bytes; its fingerprint is a polynomial in its bytes modulo 2**64,
taken from running sums so that no Python string is made.  Long words, for which
such polynomials coincide if they are made for it, get one of BLAKE2b instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
LONG_WORD = 64
_MULTIPLIER = 0x9E3779B97F4A7C15
_STEP = np.uint64(_MULTIPLIER)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits (a bijection)."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP) | np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


class Powers:
    """Powers of the multiplier and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return Powers, ()  # tasks make their own

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, BLOCK_BYTES)
            self.up = _powers(_MULTIPLIER, size)
            self.down = _powers(pow(_MULTIPLIER, -1, 1 << 64), size)
        return self.up[:count], self.down[:count]


POWERS = Powers()


def byte_table(pattern_bytes: bytes, inside: bool) -> np.ndarray:
    """Which of the 256 bytes belong to words: the listed ones, or all others."""
    table = np.full(256, not inside)
    table[list(pattern_bytes)] = inside
    return table


# The contracts' separators (blank and \x09-\x0D), and letters, digits and all non-ASCII bytes.
BLANK_SEPARATED = byte_table(bytes([0x20, *range(0x09, 0x0E)]), inside=False)
ALPHANUMERIC = byte_table(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]), inside=True)
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks] or [pa.array([], pa.large_binary())])
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(bounds) == 0:
        bounds = np.zeros(1, np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with about ``size`` bytes; a longer text is a range of its own."""
    first, last = 0, len(offsets) - 1
    while first < last:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, min(end, last)
        first = min(end, last)


@dataclass
class Words:
    """Words of consecutive texts: byte range, position of the text, fingerprint."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    prints: np.ndarray

    def counts(self, texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=texts).astype(np.int64)


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts data[offsets[i]:offsets[i+1]]; byte ranges count from data[0]."""
    size = int(offsets[-1])
    inside = np.zeros(size + 2, bool)
    np.take(table, data[:size], out=inside[1:-1])
    cuts = np.zeros(size + 1, bool)
    cuts[offsets] = True
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | cuts))
    ends = np.flatnonzero(before & (~here | cuts))
    up, down = POWERS.upto(size + 1)
    values = BYTE_VALUES[LOWERED] if lower else BYTE_VALUES
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(values[data[:size]] * up[:size], out=sums[1:])
    prints = mixed((sums[ends] - sums[starts]) * down[starts])
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        word = data[starts[k] : ends[k]]
        digest = blake2b((LOWERED[word] if lower else word).tobytes(), digest_size=8).digest()
        prints[k] = int.from_bytes(digest, "little")
    text = np.searchsorted(offsets, starts, side="right") - 1
    return Words(starts, ends, text, prints)


def windows(words: Words, length: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of the window at each word, and whether it lies within one text."""
    count = len(words.prints) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = np.full(count, length + (salt << 32), np.uint64)
    step = _STEP ^ np.uint64(salt << 1)
    for k in range(length):
        out = out * step + words.prints[k : k + count]
    return mixed(out), words.text[:count] == words.text[length - 1 :]


def covered(starts: np.ndarray, length: int | np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in one of the runs of ``length`` from ``starts``."""
    order = np.argsort(starts, kind="stable")
    begin = starts[order]
    reach = np.maximum.accumulate((starts + length)[order]) if len(order) else begin
    opens = np.ones(len(begin), bool)
    opens[1:] = begin[1:] > reach[:-1]
    steps = np.zeros(size + 1, np.int8)
    steps[begin[opens]] = 1
    steps[reach[np.append(np.flatnonzero(opens)[1:], len(begin)) - 1] if len(begin) else begin] = -1
    return np.cumsum(steps[:size], dtype=np.int8) > 0
