"""Sorting of suffixes that are compared by hashes.

Prefix sums of a polynomial give the hash of any run of bytes at once.  The
common extension of two suffixes is found by binary search over the length at
which their hashes still agree, so that a comparison takes a logarithmic number
of steps however much two suffixes share.  A mergesort orders the suffixes by
such comparisons; neighbours that agree in full are verified byte by byte.

Everything works on whole arrays: a merge step is done for all runs of all
groups together.
"""

from __future__ import annotations

import numpy as np

from vitrine.llm.words import BYTE_VALUES, POWERS


class Suffixes:
    """Suffixes of a byte string, compared over their first ``length`` bytes, which must all exist."""

    def __init__(self, content: np.ndarray, length: int) -> None:
        self.length = length
        self.content = np.concatenate((content, np.zeros(8, np.uint8)))
        up, self.down = POWERS.upto(len(content) + 1)
        self.sums = np.zeros(len(content) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[content] * up[: len(content)], out=self.sums[1:])
        self.eight = np.zeros(len(content) + 1, np.uint64)  # eight bytes from each place on, as one number
        for k in range(8):
            self.eight = self.eight << np.uint64(8) | self.content[k : k + len(content) + 1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at ``a`` and ``b`` have in common, at most ``length``."""
        sum_a, sum_b, down_a, down_b = self.sums[a], self.sums[b], self.down[a], self.down[b]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length)
        for _ in range(int(self.length).bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.sums[a + middle] - sum_a) * down_a == (self.sums[b + middle] - sum_b) * down_b
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def precedes(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at ``a`` sorts before that at ``b``, or is equal to it where ``or_equal``."""
        shared = self.common(a, b)
        return np.where(shared == self.length, or_equal, self.content[a + shared] < self.content[b + shared])

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the suffixes agree in full: by their hashes, and verified byte by byte."""
        same = np.zeros(len(a), bool)
        full = np.flatnonzero(self.common(a, b) == self.length)
        for k in (*range(0, self.length - 7, 8), self.length - 8):
            full = full[self.eight[a[full] + k] == self.eight[b[full] + k]]
        same[full] = True
        return same

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes at ``starts`` within each group, groups ascending.

        Runs for the mergesort are made as large as cheap comparisons allow:
        first by the leading eight bytes, then by where a suffix departs from
        the first of its run and the eight bytes there.  Suffixes equal to that
        first one need no more sorting.
        """
        order = np.lexsort((self.eight[starts], group))
        ranked = starts[order]
        new = _changes(group[order], self.eight[ranked])
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        tied = np.bincount(run)[run] > 1
        some = np.flatnonzero(tied)
        if not len(some):
            return order
        own, pivot = ranked[some], ranked[first[run[some]]]
        shared = self.common(own, pivot)
        less = (shared < self.length) & (self.content[own + shared] < self.content[pivot + shared])
        more = (shared < self.length) & ~less
        side = less * (shared - self.length) + more * (self.length - shared)
        following = np.where(shared < self.length, self.eight[own + shared], np.uint64(0))
        again = np.lexsort((following, side, run[some]))
        order[some] = order[some][again]
        ranked[some] = starts[order[some]]
        split = _changes(run[some], side[again], following[again]) | (side[again] == 0)
        new[some] |= split
        return self._merge_runs(order, ranked, new)

    def _merge_runs(self, order: np.ndarray, ranked: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Bottom-up mergesort within the groups that start where ``new`` is true."""
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        size = np.bincount(group)
        width = 1
        while width < size.max(initial=0):
            at = np.flatnonzero((size > width)[group])
            begin, end = first[group[at]], (first + size)[group[at]]
            rank = at - begin
            block = begin + rank // (2 * width) * (2 * width)
            left = at - block < width
            other = np.where(left, np.minimum(block + width, end), block)
            low, high = other.copy(), np.where(left, np.minimum(block + 2 * width, end), block + width)
            own = ranked[at]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                before = self.precedes(ranked[middle], own[open_], ~left[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            place = block + (at - np.where(left, block, block + width)) + (low - other)
            moved, sources = order[at], own
            order[place], ranked[place] = moved, sources
            width *= 2
        return order


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new
