"""Signature tree over token sets, joined with itself.

A leaf holds a few sets, a node a few leaves or nodes. Every node has the OR of the
token bitmaps below it, the range of their sizes, and the most tokens that one set loses
to shared bits. Two nodes are opened together only while the overlap that any two of
their sets can have at most still reaches the least overlap that a link needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 16
FAN_OUT = 8
LEAST_BITS, MOST_BITS = 512, 1 << 16


@dataclass
class Node:
    bits: np.ndarray
    low: int
    high: int
    lost: int
    children: list[Node] | None
    members: np.ndarray | None


class UnionFind:
    def __init__(self, n: int):
        self.parent = list(range(n))
        self.groups = n

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.groups -= 1


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


class SignatureTree:
    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        bits = LEAST_BITS
        while bits < min(2 * int(self.size.max()), MOST_BITS):
            bits *= 2
        marks = np.zeros((len(sets), bits), bool)
        for row, tokens in enumerate(sets):
            marks[row, (tokens & np.uint64(bits - 1)).astype(np.int64)] = True
        self.bits = np.packbits(marks, axis=1).view(np.uint64)
        self.lost = self.size - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        order = np.argsort(self.size, kind="stable")
        level = [self._leaf(order[i : i + LEAF]) for i in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self._node(level[i : i + FAN_OUT]) for i in range(0, len(level), FAN_OUT)]
        self.top = level[0]

    def _leaf(self, members: np.ndarray) -> Node:
        size = self.size[members]
        bits = np.bitwise_or.reduce(self.bits[members], axis=0)
        return Node(bits, int(size.min()), int(size.max()), int(self.lost[members].max()), None, members)

    def _node(self, below: list[Node]) -> Node:
        bits = np.bitwise_or.reduce([n.bits for n in below], axis=0)
        return Node(
            bits, min(n.low for n in below), max(n.high for n in below), max(n.lost for n in below), below, None
        )

    def links(self, percent: int, groups: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Pairs that connect all that links connect: sets already connected are not compared again.

        A link: 100 x common tokens >= percent x tokens of either. ``groups``: sets of one
        group count as connected.
        """
        found: list[tuple[int, int]] = []
        joined = UnionFind(len(self.sets))
        if groups is not None:
            first: dict = {}
            for i, g in enumerate(groups.tolist()):
                joined.join(first.setdefault(g, i), i)
        stack = [(self.top, self.top)]
        while stack and joined.groups > 1:
            x, y = stack.pop()
            if not self._may_link(x, y, percent):
                continue
            if x.children is None and y.children is None:
                self._compare(x.members, y.members, percent, joined, found)
            elif x is y:
                # Equal nodes on top of the stack: near sets are connected before far ones are compared.
                pairs = [(a, b) for i, a in enumerate(x.children) for b in x.children[i:]]
                stack.extend(sorted(pairs, key=lambda p: p[0] is p[1]))
            elif y.children is None or (x.children is not None and x.high - x.low >= y.high - y.low):
                stack.extend((a, y) for a in x.children)
            else:
                stack.extend((x, b) for b in y.children)
        return self._stars(found)

    def _stars(self, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The same connections, each set with the first of those it is connected to."""
        linked = UnionFind(len(self.sets))
        for i, j in found:
            linked.join(i, j)
        return [(linked.root(i), i) for i in range(len(self.sets)) if linked.root(i) != i]

    @staticmethod
    def _may_link(x: Node, y: Node, percent: int) -> bool:
        if 100 * min(x.high, y.high) < percent * max(x.low, y.low):
            return False
        common = int(np.bitwise_count(x.bits & y.bits).sum(dtype=np.int64)) + min(x.lost, y.lost)
        most = min(x.high, y.high, common)
        return (100 + percent) * most >= percent * (x.low + y.low)

    def _compare(self, x: np.ndarray, y: np.ndarray, percent: int, joined: UnionFind, found: list) -> None:
        a, b = self.bits[x][:, None], self.bits[y][None]
        either = np.bitwise_count(a & b).sum(axis=2, dtype=np.int64)
        # A token of a set whose bit the other lacks is not common.
        own_x = self.size[x] - np.bitwise_count(self.bits[x]).sum(axis=1, dtype=np.int64)
        own_y = self.size[y] - np.bitwise_count(self.bits[y]).sum(axis=1, dtype=np.int64)
        most = either + np.minimum(own_x[:, None], own_y[None])
        total = self.size[x][:, None] + self.size[y][None]
        able = (100 + percent) * np.minimum(most, np.minimum(self.size[x][:, None], self.size[y][None])) >= percent * total
        for p, q in sorted(zip(*np.nonzero(able), strict=True), key=lambda pq: -most[pq]):
            i, j = int(x[p]), int(y[q])
            if i == j or joined.root(i) == joined.root(j):
                continue
            if (100 + percent) * overlap(self.sets[i], self.sets[j]) >= percent * (self.size[i] + self.size[j]):
                joined.join(i, j)
                found.append((i, j))
