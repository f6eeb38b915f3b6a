"""Rows that walk through the splits of all trees of a forest at once (K4, K5).

One pass reads a row's features a single time and takes it down every tree: the features that
splits look at are laid out as columns of a chunk of rows, and a level is a few array
operations for all (row, tree). What a pass returns is made where the row is read: class counts
of nodes, class counts of the features that nodes look at, rows of chosen nodes, or leaves.
Functions are pickled by value, so executors need no copy of the package.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 2_000_000  # numbers of a chunk's arrays

# Poisson(1) distribution function: how often a row is drawn into a tree's sample.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


@dataclass
class Chunk:
    """Rows of a batch: entry k is the value ``v[k]`` of feature ``f[k]`` of the row ``row[k]``;
    weights, nodes and slots (a node's place in its level, -1 above) are (row, tree) arrays."""

    batch: pa.RecordBatch
    row: np.ndarray
    f: np.ndarray
    v: np.ndarray
    sizes: np.ndarray
    label: np.ndarray
    w: np.ndarray
    slot: np.ndarray
    node: np.ndarray


class Levels:
    """The splits of ``trees`` trees level by level, and the nodes of the level below them."""

    def __init__(self, trees: int):
        self.trees = trees
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # by slot: feature, threshold, first child
        self.tree = np.arange(trees, dtype=np.int32)
        self.node = np.ones(trees, np.int64)

    def slots(self, nodes: list[tuple[int, int]]) -> np.ndarray:
        """The slots of the given (tree, node) of the lowest level."""
        at = {key: i for i, key in enumerate(zip(self.tree.tolist(), self.node.tolist()))}
        return np.array([at[n] for n in nodes], np.int64)

    def add(self, splits: list[tuple[int, int, int, float]]) -> None:
        """One level more: the (tree, node, feature, threshold) of the lowest level."""
        at = self.slots([(t, n) for t, n, _, _ in splits])
        by = np.argsort(at)
        feature, cut = np.zeros(len(self.tree), np.int64), np.zeros(len(self.tree))
        child = np.full(len(self.tree), -1, np.int64)
        feature[at], cut[at] = [s[2] for s in splits], [s[3] for s in splits]
        child[at[by]] = 2 * np.arange(len(by))
        self.splits.append((feature, cut, child))
        self.tree = np.repeat(self.tree[at[by]], 2)
        self.node = np.repeat(2 * self.node[at[by]], 2) + np.tile([0, 1], len(by))


def _chunks(batch: pa.RecordBatch, levels: Levels, used: np.ndarray) -> Iterator[Chunk]:
    """The batch in pieces whose arrays are of bounded size."""
    entries = len(batch.column("features").flatten())
    wide = max(len(used), levels.trees, entries // max(batch.num_rows, 1), 1)
    step = max(16, CELLS // wide)
    for begin in range(0, batch.num_rows, step):
        part = batch.slice(begin, step)
        features = part.column("features")
        sizes = features.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        pairs = features.flatten()
        f, v = (x.to_numpy(zero_copy_only=False) for x in pairs.flatten())
        row = np.repeat(np.arange(len(sizes)), sizes)
        code = (row << 32) + f
        if not (code[1:] > code[:-1]).all():  # a feature that a row names twice has its first value
            first = np.unique(code, return_index=True)[1]
            row, f, v = row[first], f[first], v[first]
        learn = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        w = np.ones((len(sizes), levels.trees), np.int64)
        if "draws" in part.schema.names:
            u = part.column("draws").flatten().to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(11)
            w = np.searchsorted(POISSON, u.astype(np.float64) / (1 << 53), side="right").reshape(w.shape)
        w = w * learn[:, None]
        label = part.column("label").fill_null(0).to_numpy(zero_copy_only=False)
        slot = np.tile(np.arange(levels.trees), (len(sizes), 1))
        node = np.ones(slot.shape, np.int64)
        dense = np.zeros((len(sizes), len(used)))
        if len(used):
            place = np.minimum(np.searchsorted(used, f), len(used) - 1)
            hit = used[place] == f
            dense[row[hit], place[hit]] = v[hit]
        for feature, cut, child in levels.splits:
            i, t = np.nonzero((slot >= 0) & (child[slot] >= 0))
            s = slot[i, t]
            right = (dense[i, np.searchsorted(used, feature[s])] > cut[s]).astype(np.int64)
            slot = np.full(slot.shape, -1, np.int64)
            slot[i, t] = child[s] + right
            node[i, t] = 2 * node[i, t] + right
        yield Chunk(part, row, f, v, sizes, label, w, slot, node)


def walking(levels: Levels, use: Callable[[Chunk], Iterator[pa.RecordBatch]]):
    """``use`` of every chunk of rows, as a function for mapInArrow. Rows have (key, label, learn,
    features) and, where samples are drawn, a hash for each tree."""
    used = np.unique(np.concatenate([np.zeros(0, np.int64)] + [f[child >= 0] for f, _, child in levels.splits]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch, levels, used):
                yield from use(chunk)
    return run


def _counted(c: Chunk) -> list[np.ndarray]:
    """The slots of the lowest level that the rows reach, their class counts and their entries."""
    i, t = np.nonzero(c.slot >= 0)
    some, s = np.unique(c.slot[i, t], return_inverse=True)
    w, ones = c.w[i, t], (c.w * (c.label != 0)[:, None])[i, t]
    return [some, *[np.bincount(s, x, len(some)).astype(np.int64) for x in (w - ones, ones, c.sizes[i])]]


TOTALS = "tree int, node long, n0 long, n1 long, entries long"


def totals(levels: Levels):
    """(tree, node, n0, n1, entries) of the lowest level, in parts."""
    tree, node = levels.tree, levels.node

    def use(c: Chunk) -> Iterator[pa.RecordBatch]:
        s, *sums = _counted(c)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tree[s], node[s], *sums)],
                                         names=["tree", "node", "n0", "n1", "entries"])
    return walking(levels, use)


COUNTS = "tree int, node long, f int, v double, s0 long, s1 long"


def counts(levels: Levels, slots: np.ndarray, features: np.ndarray):
    """(tree, node, f, v, s0, s1), in parts: class counts of the entries of the features that
    the nodes in the slots look at, and with f null those of all nodes of the lowest level."""
    by = np.argsort(features, kind="stable")
    slots, (names, begin, number) = slots[by], np.unique(features[by], return_index=True, return_counts=True)
    tree, node = levels.tree, levels.node

    def entries(c: Chunk, some: np.ndarray, place: np.ndarray):
        """The entries ``some`` at the nodes that look at their features."""
        often = number[place]
        e = np.repeat(some, often)
        within = np.arange(len(e)) - np.repeat(np.cumsum(often) - often, often)
        s = slots[np.repeat(begin[place], often) + within]
        there = c.slot[c.row[e], tree[s]] == s
        e, s = e[there], s[there]
        w = c.w[c.row[e], tree[s]]
        e, s, w = e[w > 0], s[w > 0], w[w > 0]
        ones = w * (c.label[c.row[e]] != 0)
        return [tree[s], node[s], c.f[e].astype(np.int32), c.v[e], w - ones, ones]

    def use(c: Chunk) -> Iterator[pa.RecordBatch]:
        at, n0, n1, _ = _counted(c)
        nothing = pa.nulls(len(at), pa.int32())
        found = [[pa.array(tree[at]), pa.array(node[at]), nothing, nothing.cast(pa.float64()), pa.array(n0), pa.array(n1)]]
        if len(names):
            place = np.minimum(np.searchsorted(names, c.f), len(names) - 1)
            some = np.flatnonzero((names[place] == c.f) & (c.w > 0).any(axis=1)[c.row])
            place = place[some]
            parts = np.cumsum(number[place]) // CELLS  # pieces of bounded size
            cuts = np.flatnonzero(np.diff(parts)) + 1
            found += [[pa.array(x) for x in entries(c, a, b)] for a, b in zip(np.split(some, cuts), np.split(place, cuts))]
        for columns in found:
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "f", "v", "s0", "s1"])
    return walking(levels, use)


def rows_at(levels: Levels, slots: np.ndarray, learnt: bool):
    """(key, tree, node, label, w, features) of the rows at the nodes in the slots; with
    ``learnt``, those of a weight."""
    wanted = np.zeros(len(levels.tree) + 1, bool)  # -1 is the last one
    wanted[slots] = True

    def use(c: Chunk) -> Iterator[pa.RecordBatch]:
        i, t = np.nonzero(wanted[c.slot] & ((c.w > 0) | (not learnt)))
        at = pa.array(i)
        yield pa.RecordBatch.from_arrays(
            [c.batch.column("key").take(at), pa.array(t.astype(np.int32)), pa.array(c.node[i, t]), c.batch.column("label").take(at),
             pa.array(c.w[i, t].astype(np.int32)), c.batch.column("features").take(at)],
            names=["key", "tree", "node", "label", "w", "features"])
    return walking(levels, use)


def leaves(levels: Levels):
    """(key, tree, node, w): the last node of every row in every tree, and its weight there."""

    def use(c: Chunk) -> Iterator[pa.RecordBatch]:
        n, trees = c.node.shape
        yield pa.RecordBatch.from_arrays(
            [c.batch.column("key").take(pa.array(np.repeat(np.arange(n), trees))),
             pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), pa.array(c.node.ravel()), pa.array(c.w.ravel().astype(np.int32))],
            names=["key", "tree", "node", "w"])
    return walking(levels, use)
