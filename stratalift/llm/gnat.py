"""Nearest entry by a geometric near-neighbour access tree (GNAT).

A node has a few split points among its entries; every other entry belongs to the
split point it is nearest to. For each pair of split points the node knows
the range of distances from the one to all that belong to the other. A query's
distance to a split point, and the distance of the best entry met so far, then
rule out whole subtrees by the triangle inequality. Queries go down in batches.

Points and squared distances are integers, and these alone decide between
entries; equal ones go to the lower index. Only the ranges and radii are
floating point. They are widened (``LOW``, ``HIGH``), and a subtree is ruled out only
where it is strictly farther, so that neither rounding nor a tie loses an entry.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

DEGREE = 4
# More than a conversion to double and a square root can be off by.
LOW, HIGH = 1 - 2.0**-50, 1 + 2.0**-50
FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Node:
    splits: list[int]
    children: list[Node | None]
    # distances from split point i to split point j and all below it; for i = j to all below it
    nearest: np.ndarray
    farthest: np.ndarray


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    off = points - entry
    return np.einsum("ij,ij->i", off, off)


def build(entries: np.ndarray, among: Sequence[int] | None = None, degree: int = DEGREE) -> Node:
    """The tree of the entries, which are rows of integers."""
    among = list(range(len(entries))) if among is None else list(among)
    own = entries[among]
    splits = [0]
    apart = squared(own, own[0])
    while len(splits) < min(degree, len(among)):
        splits.append(int(np.argmax(np.where(np.isin(np.arange(len(among)), splits), -1, apart))))
        apart = np.minimum(apart, squared(own, own[splits[-1]]))
    distances = np.array([squared(own, own[s]) for s in splits])
    below: list[list[int]] = [[] for _ in splits]
    for k in range(len(among)):
        if k not in splits:
            below[int(np.argmin(distances[:, k]))].append(k)
    roots = np.sqrt(distances.astype(np.float64))
    nearest, farthest = np.full((2, len(splits), len(splits)), np.inf)
    farthest = -farthest
    for j, group in enumerate(below):
        for i in range(len(splits)):
            held = group if i == j else [splits[j], *group]
            if held:
                nearest[i, j] = roots[i, held].min() * LOW
                farthest[i, j] = roots[i, held].max() * HIGH
    children = [build(entries, [among[k] for k in g], degree) if g else None for g in below]
    return Node([among[s] for s in splits], children, nearest, farthest)


class Search:
    """The nearest entry of every point; ``compared`` counts the distances taken."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE) -> None:
        self.entries = np.ascontiguousarray(entries, np.int64)
        self.root = build(self.entries, degree=degree)
        self.compared = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance, per row of integers."""
        best = np.full(len(points), FAR)
        index = np.full(len(points), len(self.entries))
        self._descend(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _descend(self, node: Node, points, rows, best, index) -> None:
        alive = np.ones((len(node.splits), len(rows)), bool)
        reach = np.empty((len(node.splits), len(rows)))
        for i, split in enumerate(node.splits):
            at = np.flatnonzero(alive[i])
            if not len(at):
                continue
            mine = rows[at]
            found = squared(points[mine], self.entries[split])
            self.compared += len(mine)
            better = (found < best[mine]) | ((found == best[mine]) & (split < index[mine]))
            best[mine[better]], index[mine[better]] = found[better], split
            reach[i, at] = distance = np.sqrt(found.astype(np.float64))
            radius = np.sqrt(best[mine].astype(np.float64)) * HIGH
            for j in range(len(node.splits)):
                # of split points already compared only what is below them is left to rule out
                if j != i and (j > i or node.children[j]):
                    alive[j, at] &= ~self._out_of_reach(node, i, j, distance, radius)
        for j, child in enumerate(node.children):
            at = np.flatnonzero(alive[j]) if child else ()
            if len(at):
                radius = np.sqrt(best[rows[at]].astype(np.float64)) * HIGH
                at = at[~self._out_of_reach(node, j, j, reach[j, at], radius)]
            if len(at):
                self._descend(child, points, rows[at], best, index)

    @staticmethod
    def _out_of_reach(node: Node, i: int, j: int, distance, radius) -> np.ndarray:
        beyond = distance * LOW - node.farthest[i, j]
        before = node.nearest[i, j] - distance * HIGH
        # the difference may be rounded up by far less than this
        return np.maximum(beyond, before) - distance * 2.0**-50 > radius
