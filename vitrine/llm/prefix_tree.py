"""Similar sets among a bounded number, by a prefix tree.

The sets are sorted by one order of all their tokens, the most frequent first,
and stored in a tree whose nodes hold runs of tokens.  A set is looked up by
walking down the tree: sets with a common beginning share the count of tokens
they have in common with it.  A subtree is left as soon as what remains of its
longest set, or of the set looked up, can't make the overlap large enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def least_overlap(a: int, b: int, percent: int) -> int:
    """How many tokens sets of these sizes must share to be similar."""
    return -(-percent * (a + b) // (100 + percent))


class Groups:
    """Which sets are known to be connected."""

    def __init__(self, count: int) -> None:
        self.parent = list(range(count))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)


class _Node:
    __slots__ = ("run", "children", "ends", "smallest", "longest", "some", "alike")

    def __init__(self, run: np.ndarray) -> None:
        self.run = run
        self.children: dict[int, _Node] = {}
        self.ends: list[int] = []
        self.smallest = 1 << 60  # size of the smallest set below
        self.longest = 0  # tokens of the longest path, this node's included
        self.some = -1  # a set below, and whether all below are connected to it
        self.alike = True


class PrefixTree:
    """Sets by number; ``sizes`` count tokens that aren't stored too."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], percent: int) -> None:
        self.percent, self.sizes = percent, sizes
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        tokens, place, count = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens, -count))] = np.arange(len(tokens))
        common = int((count > 1).sum())  # tokens of one set only come last and are left out
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        self.sets = [np.sort(r[r < common]) for r in np.split(rank[place], cuts)]
        self.present = np.zeros(common, bool)
        self.groups = Groups(len(sets))
        self.root = _Node(np.zeros(0, np.int64))

    def links(self, look_up: list[int] | None = None) -> Iterator[tuple[int, int]]:
        """Pairs of similar sets that connect all that similar sets connect.

        With ``look_up`` those are held against the others, which are stored
        without a look-up of their own.
        """
        asked = set(range(len(self.sets)) if look_up is None else look_up)
        if look_up is not None:
            for i in range(len(self.sets)):
                if i not in asked:
                    self._insert(i)
        for i in sorted(asked, key=lambda i: (self.sizes[i], i)):
            yield from self._find(i)
            if look_up is None:
                self._insert(i)

    def stars(self, look_up: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same connections as pairs of a set and the first set it is connected to."""
        for _ in self.links(look_up):
            pass
        first = np.array([self.groups.find(i) for i in range(len(self.sets))], np.int64)
        others = np.flatnonzero(first != np.arange(len(first)))
        return others, first[others]

    def _find(self, i: int) -> Iterator[tuple[int, int]]:
        own, size, groups = self.sets[i], self.sizes[i], self.groups
        self.present[own] = True
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if node.some < 0 or (node.alike and groups.find(node.some) == groups.find(i)):
                continue
            needed = least_overlap(size, node.smallest, self.percent)
            if shared + node.longest < needed:
                continue
            if len(node.run):
                left = len(own) - np.searchsorted(own, node.run[0])
                if shared + left < needed:
                    continue
                shared += int(np.count_nonzero(self.present[node.run]))
            for j in node.ends:
                if shared >= least_overlap(size, self.sizes[j], self.percent) and groups.find(i) != groups.find(j):
                    groups.join(i, j)
                    yield i, j
            stack.extend((child, shared) for child in node.children.values())
        self.present[own] = False

    def _insert(self, i: int) -> None:
        own, node, at = self.sets[i], self.root, 0
        self._count_in(node, i, len(own))
        while at < len(own):
            child = node.children.get(int(own[at]))
            if child is None:
                child = _Node(own[at:])
                node.children[int(own[at])] = child
                self._count_in(child, i, len(own) - at)
                child.ends.append(i)
                return
            width = min(len(child.run), len(own) - at)
            differs = np.flatnonzero(child.run[:width] != own[at : at + width])
            width = int(differs[0]) if len(differs) else width
            if width < len(child.run):
                child = self._split(node, child, width)
            self._count_in(child, i, len(own) - at)
            at += width
            node = child
        node.ends.append(i)

    def _count_in(self, node: _Node, i: int, length: int) -> None:
        node.smallest = min(node.smallest, self.sizes[i])
        node.longest = max(node.longest, length)
        if node.some < 0:
            node.some = i
        elif node.alike:
            node.alike = self.groups.find(node.some) == self.groups.find(i)

    @staticmethod
    def _split(parent: _Node, child: _Node, width: int) -> _Node:
        upper = _Node(child.run[:width])
        upper.smallest, upper.longest = child.smallest, child.longest
        upper.some, upper.alike = child.some, child.alike
        child.run = child.run[width:]
        child.longest -= width
        upper.children[int(child.run[0])] = child
        parent.children[int(upper.run[0])] = upper
        return upper
