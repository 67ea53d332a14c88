"""Isolation forest: rows that random splits part from all others soon are anomalous.

Each tree is grown on a small random part of the training rows: a random column is cut at a
random place between its least and largest value, until a row is alone or the tree is as deep
as a balanced one would be. The path length of a row, averaged over the trees, against that of
a random search tree gives its anomaly, from 0 to 1; 0.5 is ordinary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EULER = 0.5772156649015329


def usual_path(rows: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random binary tree of so many rows."""
    rows = np.asarray(rows, dtype=np.float64)
    many = np.maximum(rows, 3)
    found = 2 * (np.log(many - 1) + _EULER) - 2 * (many - 1) / many
    return np.where(rows > 2, found, np.where(rows == 2, 1.0, 0.0))


@dataclass
class Tree:
    """Nodes as arrays; a leaf points to itself and has the path length of its rows."""

    column: np.ndarray
    cut: np.ndarray
    below: np.ndarray  # next node for smaller values
    above: np.ndarray
    path: np.ndarray
    depth: int

    def paths(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        every = np.arange(len(rows))
        for _ in range(self.depth):
            at = np.where(rows[every, self.column[at]] < self.cut[at], self.below[at], self.above[at])
        return self.path[at]


def _grow(rows: np.ndarray, rng: np.random.Generator) -> Tree:
    depth = int(np.ceil(np.log2(max(len(rows), 2))))
    nodes: list[list] = []

    def add(part: np.ndarray, level: int) -> int:
        number = len(nodes)
        nodes.append([0, 0.0, number, number, level + float(usual_path(len(part)))])
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if len(part) > 1 and level < depth and len(varied):
            column = int(rng.choice(varied))
            cut = float(rng.uniform(low[column], high[column]))
            cut = cut if cut > low[column] else float(high[column])
            smaller = part[:, column] < cut
            below = add(part[smaller], level + 1)
            above = add(part[~smaller], level + 1)
            nodes[number] = [column, cut, below, above, 0.0]
        return number

    add(rows, 0)
    column, cut, below, above, path = (np.array(x) for x in zip(*nodes))
    return Tree(column, cut, below, above, path, depth)


@dataclass
class Forest:
    trees: list[Tree]
    usual: float

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        """From 0 to 1, higher: parted from others sooner."""
        total = np.zeros(len(rows))
        for tree in self.trees:
            total += tree.paths(rows)
        return 2.0 ** (-total / len(self.trees) / self.usual)


def grow_forest(rows: np.ndarray, trees: int, part: int, seed: int) -> Forest | None:
    """``trees`` trees, each on ``part`` of the rows at most; none without two different rows."""
    if len(rows) < 2 or (rows == rows[0]).all():
        return None
    rng = np.random.default_rng(seed)
    size = min(part, len(rows))
    grown = [_grow(rows[rng.choice(len(rows), size, replace=False)], rng) for _ in range(trees)]
    return Forest(grown, max(float(usual_path(size)), 1.0))
