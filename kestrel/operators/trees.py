"""Exact decision trees and random forests over sparse rows (K4-K6).

A row carries its features as an array of (f, v) with the zeros left out, so 2^18 hashed
features cost what the row holds. Trees of a forest grow together, level by level: the
class counts per (tree, node, feature, value) are one aggregation, the zeros of a feature
are the node's totals less what was counted, and running sums along the values give every
threshold between neighbouring values (midpoints). There are no bins, hence no limit on
features or depth. The best threshold of a node has the least Gini impurity; ties go to the
lower feature, then the lower threshold. Spark ML finds the same splits where its bins hold
every value; it also merges sibling leaves that predict alike, which changes no prediction.
Nodes are numbered as in a heap, so a row's last
node tells its whole path, and a tree cut at any depth is a shift of that number.

All rows travel along, test rows too, and land in their leaf. While nodes are few, rows walk
through all trees where they are read (``walks``), one pass a level, and no row is copied for
each tree; beyond that, and where keys repeat, a row is a row for each tree. A node whose rows hold at most ``TASK_ENTRIES`` entries is finished with its whole
subtree in one task, by the same rules, so deep trees don't cost a job per level.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators import walks
from kestrel.operators.features import has_repeats
from kestrel.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = "array<struct<f:int,v:double>>"
TASK_ENTRIES = 4_000_000   # (row, feature) entries that a task may hold
LARGE = 65_536             # distinct values from which a feature is summed in ranges
BROADCAST_ROWS = 100_000   # splits of a level that are broadcast (counted)
WALK = 8                   # levels that rows walk again before their nodes are written
DRAWN = 4_000_000          # features of nodes that are broadcast
MARGIN = 1e-9              # a split must lower the impurity by more than rounding does


def sparse(array: str | Column) -> Column:
    """The array of (f, v) of a dense array of numbers."""
    a = F.col(array) if isinstance(array, str) else array
    pairs = F.transform(a.cast("array<double>"), lambda v, i: F.struct(i.alias("f"), v.alias("v")))
    return F.filter(pairs, lambda p: p["v"] != 0).cast(FEATURES)


def _uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) from a hash of the parts: the same in any partitioning."""
    cols = [F.lit(p) if isinstance(p, int) else F.col(p) if isinstance(p, str) else p for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(1 << 53)


def _draws(u: Column) -> Column:
    """How often a row is in a bootstrap sample: Poisson(1) at the uniform ``u``."""
    return sum(((u >= F.lit(float(c))).cast("int") for c in walks.POISSON), F.lit(0))


def _gain(l0, l1, r0, r1):
    """What a split keeps of the squared class counts per row: large where the sides are pure."""
    return (l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1)


def finish_subtree(node: int, label: np.ndarray, weight: np.ndarray, row: np.ndarray, feature: np.ndarray,
                   value: np.ndarray, levels: int) -> np.ndarray:
    """The last node of every row of the subtree under ``node``, at most ``levels`` deeper.
    Rows of weight 0 (test rows) only travel. (row, feature, value) are the entries."""
    nodes = np.full(len(label), node, np.int64)
    still = np.ones(len(label), bool)  # in a node that may be split
    by = np.lexsort((value, feature))
    row, feature, value = row[by], feature[by], value[by]
    c0, c1 = weight * (label == 0), weight * (label != 0)
    for _ in range(levels):
        names, at = np.unique(nodes[still], return_inverse=True)
        own = np.full(len(label), -1)
        own[still] = at
        n0 = np.bincount(at, c0[still], len(names))
        n1 = np.bincount(at, c1[still], len(names))
        used = np.flatnonzero((weight[row] > 0) & (own[row] >= 0) & ((n0 > 0) & (n1 > 0))[own[row]])
        if not len(used):
            break
        used = used[np.argsort(own[row[used]], kind="stable")]
        g, f, v = own[row[used]], feature[used], value[used]
        new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (f[1:] != f[:-1]) | (v[1:] != v[:-1])]))
        s0, s1 = np.add.reduceat(c0[row[used]], new), np.add.reduceat(c1[row[used]], new)
        g, f, v = g[new], f[new], v[new]
        # The rows without an entry have the value 0.
        first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (f[1:] != f[:-1])]))
        z0, z1 = n0[g[first]] - np.add.reduceat(s0, first), n1[g[first]] - np.add.reduceat(s1, first)
        some = z0 + z1 > 0
        g, f = np.concatenate([g, g[first][some]]), np.concatenate([f, f[first][some]])
        v = np.concatenate([v, np.zeros(some.sum())])
        s0, s1 = np.concatenate([s0, z0[some]]), np.concatenate([s1, z1[some]])
        by = np.lexsort((v, f, g))
        g, f, v, s0, s1 = g[by], f[by], v[by], s0[by], s1[by]
        start = np.concatenate([[True], (g[1:] != g[:-1]) | (f[1:] != f[:-1])])
        begin = np.flatnonzero(start)[np.cumsum(start) - 1]
        r0, r1 = np.cumsum(s0), np.cumsum(s1)
        l0, l1 = r0 - (r0 - s0)[begin], r1 - (r1 - s1)[begin]
        i = np.flatnonzero(~np.concatenate([start[1:], [True]]))  # another value follows
        if not len(i):
            break
        cut = (v[i] + v[i + 1]) / 2
        gain = _gain(l0[i], l1[i], n0[g[i]] - l0[i], n1[g[i]] - l1[i])
        best = np.lexsort((cut, f[i], -gain, g[i]))
        best = best[np.concatenate([[True], g[i][best][1:] != g[i][best][:-1]])]
        g, f, cut, gain = g[i][best], f[i][best], cut[best], gain[best]
        whole = (n0[g] ** 2 + n1[g] ** 2) / (n0[g] + n1[g])
        good = gain > whole * (1 + MARGIN)
        split_f, split_v = np.full(len(names), -1), np.zeros(len(names))
        split_f[g[good]], split_v[g[good]] = f[good], cut[good]
        still &= np.where(own >= 0, split_f[own] >= 0, False)
        has = np.zeros(len(label))
        hit = still[row] & (split_f[own[row]] == feature)
        has[row[hit]] = value[hit]
        nodes[still] = 2 * nodes[still] + (has[still] > split_v[own[still]])
        if not still.any():
            break
    return nodes


def _finish(some: DataFrame, levels: int, kind: str) -> DataFrame:
    """(key, tree, node, w) of rows whose subtrees are finished in a task each."""

    def run(keys, d: pd.DataFrame) -> pd.DataFrame:
        lens = d["fs"].map(len).to_numpy()
        flat = [np.concatenate([np.asarray(x, t) for x in d[c]]) if len(d) else np.zeros(0, t)
                for c, t in (("fs", np.int64), ("vs", np.float64))]
        depth = int(keys[1]).bit_length() - 1
        nodes = finish_subtree(int(keys[1]), d["label"].to_numpy(), d["w"].to_numpy(np.float64),
                               np.repeat(np.arange(len(d)), lens), *flat, levels - depth)
        return pd.DataFrame({"key": d["key"], "tree": d["tree"], "node": nodes, "w": d["w"]})

    return some.select("key", "tree", "node", "label", "w", F.col("features.f").alias("fs"), F.col("features.v").alias("vs")) \
               .groupBy("tree", "node").applyInPandas(run, f"key {kind}, tree int, node long, w int")


def _ranges(rows: DataFrame, names: DataFrame | None = None) -> DataFrame | None:
    """(f, cuts) of the features with many distinct values: about sqrt(n) / 4 ranges each, so
    that no running sum is one task's. The cuts are written once; they only deal the work.
    Values are only told apart where a feature has that many entries (``_features``)."""
    often = (_features(rows) if names is None else names).where(F.col("n") > LARGE).select("f")
    n = often.count()
    if not n:
        return None
    entries = rows.select(F.explode("features").alias("e")).select("e.f", "e.v").join(_few(often, n), "f")
    large = entries.groupBy("f").agg(F.approx_count_distinct("v").alias("n")).where(F.col("n") > LARGE)
    most = large.agg(F.max("n")).first()[0]
    if most is None:
        return None
    parts = max(2, math.isqrt(most) // 4)
    probs = [i / parts for i in range(1, parts)]
    return materialize(entries.join(large.select("f"), "f").groupBy("f")
                       .agg(F.percentile_approx("v", probs, 10_000).alias("cuts")))


def best_splits(counts: DataFrame, totals: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """(tree, node, f, cut): the best threshold of each node that has one.

    ``counts`` has the class counts (tree, node, f, v, s0, s1) of non-zero values, ``totals``
    those of the nodes (tree, node, n0, n1)."""
    group = ["tree", "node", "f"]
    counted = counts.groupBy(*group).agg(F.sum("s0").alias("s0"), F.sum("s1").alias("s1"))
    zeros = counted.join(totals, ["tree", "node"]) \
        .select(*group, F.lit(0.0).alias("v"), (F.col("n0") - F.col("s0")).alias("s0"),
                (F.col("n1") - F.col("s1")).alias("s1")).where("s0 + s1 > 0")
    d = counts.select(*group, "v", "s0", "s1").unionByName(zeros)
    if cuts is None:
        d = d.withColumn("part", F.lit(0))
    else:
        below = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda c: c < F.col("v")))
        d = d.join(cuts, "f", "left").withColumn("part", below).drop("cuts")
    inner = Window.partitionBy(*group, "part").orderBy("v")
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select(*group, "part", "v", *[F.sum(s).over(upto).alias(s) for s in ("s0", "s1")],
                 F.lead("v").over(inner).alias("next"))
    if cuts is not None:  # what lies before a range, and the first value after it
        parts = d.groupBy(*group, "part").agg(F.max("s0").alias("t0"), F.max("s1").alias("t1"), F.min("v").alias("low"))
        along = Window.partitionBy(*group).orderBy("part")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(*group, "part", F.lead("low").over(along).alias("low"),
                             *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(t) for t in ("t0", "t1")])
        d = d.join(parts, [*group, "part"]) \
             .select(*group, "v", (F.col("s0") + F.col("t0")).alias("s0"), (F.col("s1") + F.col("t1")).alias("s1"),
                     F.coalesce("next", "low").alias("next"))
    d = d.where("next is not null").join(totals, ["tree", "node"])
    l0, l1, n0, n1 = (F.col(c).cast("double") for c in ("s0", "s1", "n0", "n1"))
    best = d.select("tree", "node", _gain(l0, l1, n0 - l0, n1 - l1).alias("gain"), "f",
                    ((F.col("v") + F.col("next")) / 2).alias("cut"), ((n0 * n0 + n1 * n1) / (n0 + n1)).alias("whole")) \
            .groupBy("tree", "node").agg(F.max(F.struct("gain", -F.col("f"), -F.col("cut"), "whole")).alias("b"))
    return best.select("tree", "node", (-F.col("b.col2")).alias("f"), (-F.col("b.col3")).alias("cut"),
                       F.col("b.gain").alias("gain"), F.col("b.whole").alias("whole")) \
               .where(F.col("gain") > F.col("whole") * (1 + MARGIN)).select("tree", "node", "f", "cut")


def grow(rows: DataFrame, max_depth: int, trees: int = 1, bootstrap: bool = False, subset: float = 1.0,
         seed: int = 0, task_entries: int = TASK_ENTRIES) -> DataFrame:
    """(key, tree, node, w): the leaf of every row in every tree, and its weight there.

    ``rows`` is a checkpoint of (key, label, train, features): a key (unique, or slower), a label 0 or 1,
    whether the row is learnt from, and an array of (f, v). With ``bootstrap`` a row counts
    Poisson(1) times in a tree; with ``subset`` a node looks at that share of the features.
    Both are hashes of (seed, tree, row or node and feature). Null features are none, rows
    with a null label are only routed, and a table without rows to learn from gives
    every row the root. Node numbers are longs, so trees are at most 61 levels deep.
    """
    if not 0 <= max_depth <= 61:
        raise ValueError("max_depth must be between 0 and 61")
    kind = rows.schema["key"].dataType.simpleString()
    learn = F.col("train") & F.col("label").isNotNull()
    draws = _draws(_uniform(seed, "tree", "key")) if bootstrap else F.lit(1)
    data = rows.select("key", (F.col("label") != 0).cast("int").alias("label"), learn.alias("learn"),
                       F.coalesce("features", F.array().cast(FEATURES)).alias("features"))
    start = data.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")) \
        .withColumn("w", F.when(F.col("learn"), draws).otherwise(0)).withColumn("node", F.lit(1).cast("long")).drop("learn")
    in_task = task_entries if subset >= 1 else -1  # subsets of features are drawn in columns only
    names = _features(data) if subset < 1 else None
    cuts = _ranges(data, names) if subset < 1 or _entries(data) > in_task else None
    node = ["tree", "node"]
    at, steps, above = start, 0, 0
    finished, closed, n_closed, ended = [], [], 0, []
    # Rows that share a key meet at every level, so each level is written and joined by key.
    state = start.select("key", "tree", "node", "w") if has_repeats(rows, "key") else None
    if state is not None:
        at = data.join(state, "key")
    else:
        walk = _Walk(data, kind, trees, bootstrap, seed)
        finished, closed, n_closed, above, whole = _descend(walk, max_depth, subset, seed, in_task, cuts, names)
        if whole:
            return materialize(_ends(walk.leaves(), closed, n_closed, finished))
        if above:
            at = _gone_on(start, materialize(walk.leaves().select("key", "tree", "node")))
    for depth in range(above, max_depth + 1):
        # Rows of nodes that ended above keep the lower number of their leaf.
        here = at.where(F.col("node") >= 1 << depth)
        ones = F.coalesce(F.col("w") * F.col("label"), F.lit(0))
        totals = materialize(here.groupBy(*node).agg(
            F.sum(F.col("w") - ones).alias("n0"), F.sum(ones).alias("n1"), F.sum(F.size("features")).alias("entries")))
        # Nodes of one class, and all nodes at the last level, are leaves.
        mixed = totals.where("n0 > 0 and n1 > 0") if depth < max_depth else totals.limit(0)
        small, large = mixed.where(F.col("entries") <= in_task), mixed.where(F.col("entries") > in_task).drop("entries")
        n_small, n_large = mixed.agg(F.count_if(F.col("entries") <= in_task),
                                     F.count_if(F.col("entries") > in_task)).first()
        if state is not None:
            ended.append(state.join(_few(mixed.select(*node), n_small + n_large), node, "left_anti"))
        if n_small:
            finished.append(materialize(_finish(here.join(_few(small.select(*node), n_small), node), max_depth, kind)))
            closed.append(small.select(*node))
            n_closed += n_small
        if not n_large:
            break
        learnt = here.where("w > 0").join(_few(large.select(*node), n_large), node)
        if subset < 1:
            chosen = _chosen(learnt, large, n_large, names, subset, seed)
        else:
            chosen = learnt.select(*node, "label", "w", F.explode("features").alias("e")) \
                .select(*node, "label", "w", "e.f", "e.v")
        splits = materialize(best_splits(materialize(_counts(chosen)), large, cuts))
        n_splits = splits.count()
        at, steps = _step(at, splits, n_splits), steps + 1
        if state is not None:
            ended.append(state.join(_few(large.select(*node), n_large), node, "left_semi")
                              .join(_few(splits, n_splits), node, "left_anti"))
            state = materialize(at.where(F.col("node") >= 2 << depth).select("key", "tree", "node", "w"))
            at = data.join(state, "key")
        elif n_splits > BROADCAST_ROWS or steps == WALK:  # long walks go on from where they are
            reached = materialize(at.select("key", "tree", "node"))
            at, steps = _gone_on(start, reached), 0
    if state is not None:
        done = ended[0]
        for part in ended[1:]:
            done = done.unionByName(part)
        for part in finished:
            done = done.unionByName(part)
        done = done.drop("w").join(data.select("key", "learn"), "key")
        return materialize(done.select("key", "tree", "node", F.when(F.col("learn"), draws).otherwise(0).alias("w")))
    return materialize(_ends(at.select("key", "tree", "node", "w"), closed, n_closed, finished))


def _gone_on(start: DataFrame, reached: DataFrame) -> DataFrame:
    """The rows of ``start`` at the nodes (key, tree, node) that they have reached."""
    there = reached.select(F.col("key").alias("_key"), F.col("tree").alias("_tree"), "node")
    return start.drop("node").join(there, F.col("key").eqNullSafe(F.col("_key")) & (F.col("tree") == F.col("_tree"))) \
                .drop("_key", "_tree")


def _ends(leaves: DataFrame, closed: list[DataFrame], n_closed: int, finished: list[DataFrame]) -> DataFrame:
    """The leaves, but for the ``closed`` nodes those of their ``finished`` subtrees."""
    if closed:
        ends = closed[0]
        for part in closed[1:]:
            ends = ends.unionByName(part)
        leaves = leaves.join(_few(ends, n_closed), ["tree", "node"], "left_anti").select("key", "tree", "node", "w")
    for part in finished:
        leaves = leaves.unionByName(part)
    return leaves


class _Walk:
    """Passes over the rows, which walk through the levels found so far (``walks``)."""

    def __init__(self, data: DataFrame, kind: str, trees: int, bootstrap: bool, seed: int):
        hashes = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(F.lit(seed), t, F.col("key")))
        self.data = data.select("key", "label", F.coalesce("learn", F.lit(False)).alias("learn"), "features",
                                *[hashes.alias("draws")] * bootstrap)
        self.kind, self.levels = kind, walks.Levels(trees)

    def totals(self) -> DataFrame:
        """(tree, node, n0, n1, entries) of the lowest level."""
        return self.data.mapInArrow(walks.totals(self.levels), walks.TOTALS) \
            .groupBy("tree", "node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "entries")])

    def counts(self, looked: DataFrame) -> DataFrame:
        """(tree, node, f, v, s0, s1) of the lowest level for the features (at, f) that the nodes
        in the places ``at`` look at, and with f null for all its nodes."""
        found = looked.select("at", "f").toArrow()
        at, f = (found.column(c).to_numpy() for c in ("at", "f"))
        return self.data.mapInArrow(walks.counts(self.levels, at, f), walks.COUNTS) \
            .groupBy("tree", "node", "f", "v").agg(F.sum("s0").alias("s0"), F.sum("s1").alias("s1"))

    def rows_at(self, nodes: list[tuple[int, int]], learnt: bool = False) -> DataFrame:
        """(key, tree, node, label, w, features) of the rows at nodes of the lowest level."""
        return self.data.mapInArrow(walks.rows_at(self.levels, self.levels.slots(nodes), learnt),
                                    f"key {self.kind}, tree int, node long, label int, w int, features {FEATURES}")

    def leaves(self) -> DataFrame:
        """(key, tree, node, w) of every row and tree."""
        return self.data.mapInArrow(walks.leaves(self.levels), f"key {self.kind}, tree int, node long, w int")


def _descend(walk: _Walk, max_depth: int, subset: float, seed: int, in_task: int, cuts: DataFrame | None,
             names: DataFrame | None) -> tuple[list[DataFrame], list[DataFrame], int, int, bool]:
    """Finds the splits of one level after the other while their nodes, and the features that
    these look at, are few enough for every task: (finished, closed, number of closed nodes,
    levels, whether the trees are whole)."""
    finished, closed, n_closed, levels = [], [], 0, walk.levels
    n_names, found = (names.count() if subset < 1 else 0), 0
    for depth in range(max_depth):
        n = len(levels.tree)
        if n + found > BROADCAST_ROWS or subset < 1 and (
                n > BROADCAST_ROWS // 100 or n_names * n * subset > DRAWN or n * subset > 4 * levels.trees):
            return finished, closed, n_closed, depth, False
        if subset < 1:
            looked = _looked_at(names, list(zip(levels.tree.tolist(), levels.node.tolist())), subset, seed)
            counted = materialize(walk.counts(looked))
            large = counted.where("f is null and s0 > 0 and s1 > 0").select("tree", "node", F.col("s0").alias("n0"), F.col("s1").alias("n1"))
            counted = counted.where("f is not null")
        else:
            mixed = materialize(walk.totals()).where("n0 > 0 and n1 > 0")
            small, large = mixed.where(F.col("entries") <= in_task), mixed.where(F.col("entries") > in_task).drop("entries")
            parts = [[(r.tree, r.node) for r in d.select("tree", "node").collect()] for d in (small, large)]
            if parts[0]:
                finished.append(materialize(_finish(walk.rows_at(parts[0]), max_depth, walk.kind)))
                closed.append(small.select("tree", "node"))
                n_closed += len(parts[0])
            if not parts[1]:
                break
            counted = materialize(_counts(walk.rows_at(parts[1], learnt=True).select(
                "tree", "node", "label", "w", F.explode("features").alias("e")).select("tree", "node", "label", "w", "e.f", "e.v")))
        splits = [tuple(r) for r in best_splits(counted, F.broadcast(large), cuts).collect()]
        if not splits:
            break
        levels.add(splits)
        found += len(splits)
    return finished, closed, n_closed, len(levels.splits), True


def _counts(chosen: DataFrame) -> DataFrame:
    """Class counts of the entries (tree, node, label, w, f, v)."""
    return chosen.groupBy("tree", "node", "f", "v") \
        .agg(F.sum(F.col("w") * (1 - F.col("label"))).alias("s0"), F.sum(F.col("w") * F.col("label")).alias("s1"))


def _value(f: Column) -> Column:
    """The row's value of the feature ``f``."""
    place = F.array_position("features.f", f).cast("int") - 1
    return F.coalesce(F.get("features.v", place), F.lit(0.0))


def _step(at: DataFrame, splits: DataFrame, n_splits: int) -> DataFrame:
    """``at`` one level down. Where the splits are few they are broadcast, so rows find their
    way through all levels in the task that reads them."""
    on = splits.select("tree", "node", F.col("f").alias("_f"), F.col("cut").alias("_cut"))
    below = F.when(F.col("_f").isNull(), F.col("node")).otherwise(
        F.col("node") * 2 + (_value(F.col("_f")) > F.col("_cut")).cast("long"))
    return at.join(_few(on, n_splits), ["tree", "node"], "left") \
             .select("key", "label", "features", "tree", "w", below.alias("node"))


def _chosen(learnt: DataFrame, nodes: DataFrame, n_nodes: int, names: DataFrame, subset: float, seed: int) -> DataFrame:
    """(tree, node, label, w, f, v): entries of the features that the nodes look at.

    A node's features are drawn once among all ``names`` and broadcast where that is at most
    ``DRAWN`` numbers; beyond that each row draws for its own entries."""
    node, drawn = ["tree", "node"], F.lit(subset)
    if n_nodes <= BROADCAST_ROWS // 100 and names.count() * n_nodes * subset <= DRAWN:
        picks = _looked_at(names, [tuple(r) for r in nodes.select(*node).collect()], subset, seed) \
            .groupBy(*node).agg(F.collect_list("f").alias("_fs"))
        both = learnt.join(F.broadcast(materialize(picks)), node) \
            .select(*node, "label", "w", "features", F.explode_outer(F.array_intersect("features.f", "_fs")).alias("f"))
        return both.where("f is not null").select(*node, "label", "w", "f", _value(F.col("f")).alias("v"))
    chosen = F.filter("features", lambda e: _uniform(seed, "tree", "node", e["f"]) < drawn)
    return learnt.select(*node, "label", "w", F.explode(chosen).alias("e")).select(*node, "label", "w", "e.f", "e.v")


def _looked_at(names: DataFrame, nodes: list[tuple[int, int]], subset: float, seed: int) -> DataFrame:
    """(at, tree, node, f): the features among all ``names`` that the nodes look at, and the
    node's place in the list."""
    each = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(n).cast("long").alias("node")) for t, n in nodes])
    return names.select("f", F.posexplode(each).alias("at", "n")).select("at", "n.*", "f") \
                .where(_uniform(seed, "tree", "node", "f") < F.lit(subset))


def _features(data: DataFrame) -> DataFrame:
    """(f, n): the features and their entries."""
    return materialize(data.select(F.explode("features.f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n")))


def _entries(data: DataFrame) -> int:
    return data.agg(F.sum(F.size("features"))).first()[0] or 0


def _few(nodes: DataFrame, n: int) -> DataFrame:
    """Rows about ``n`` nodes, marked for broadcast where they are few."""
    return F.broadcast(nodes) if n <= BROADCAST_ROWS else nodes


def tree_scores(leaves: DataFrame, rows: DataFrame, depth: int | None = None) -> DataFrame:
    """(key, prediction, score) of every row: ``score`` is the mean over the trees of the
    share of label 1 among the learnt rows of its leaf, ``prediction`` whether it is above
    one half. ``depth`` cuts the trees there. ``leaves`` is what ``grow`` returned."""
    node = F.col("node")
    if depth is not None:
        node = F.expr(f"shiftright(node, greatest(length(bin(node)) - 1 - {int(depth)}, 0))")
    at = leaves.select("key", "tree", node.alias("node"), "w")
    labelled = at.where("w > 0").join(rows.select("key", (F.col("label") != 0).cast("int").alias("label")), "key")
    share = labelled.groupBy("tree", "node").agg((F.sum(F.col("w") * F.col("label")) / F.sum("w")).alias("p"))
    # Summed in the order of the trees, not of arrival: the same last digit in every run.
    votes = at.join(share, ["tree", "node"], "left").groupBy("key") \
              .agg(F.array_sort(F.collect_list(F.struct("tree", F.coalesce("p", F.lit(0.0)).alias("p")))).alias("votes"))
    total = F.aggregate("votes", F.lit(0.0), lambda acc, v: acc + v["p"])
    return votes.select("key", (total / F.size("votes")).alias("score")) \
                .select("key", (F.col("score") > 0.5).cast("int").alias("prediction"), "score")
