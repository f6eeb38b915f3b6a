"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is a weighted set: its five-word shingles with their counts. On the plane of
(weight, rank) every shingle has its own darts, thrown by hashing: each unit tile holds a
Poisson number of them. Darts that fall under the shingle's weight belong to the document;
each has a coordinate, and the earliest dart (least rank) of every coordinate is the
signature. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. Tiles are visited only up to the rank at which all coordinates are
filled, about ``k (ln k + 3) / weight`` rows, so a signature costs O(n + k log k).

Equal band keys make buckets; candidates are checked exactly and linked, and classes are
the connected components. A bucket is never expanded into pairs: its members are compared
with a leader, and a bucket is finished when all members that have not led are in one
class. The documents of buckets that one leader doesn't settle (those that merely share a
passage, mostly) are dealt anew by their rarest shingles (prefix filtering, which misses no
similar pair), again with leaders, sixteen times as many in each round, compared only with
members outside of their class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import (compact, drop_rows, merged, rewritten, salted_join,
                                text_digest)
from kestrel.session import remove_tree, scratch_path

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 50, 6     # P(no common band) at 0.8: (1 - 0.8^6)^50 = 3e-7
LEADERS = 16            # growth of the leaders per round
WIDE_ROWS = 20_000      # rows a partition of the tables with a row per document
SLIM_ROWS = 400_000     # rows a partition of the loops' tables, which hold a few numbers a row
MEMO = 300_000          # word hashes a worker remembers; only saves time

_EPSILON = 1e-9  # on the safe side of rounding where sizes are compared


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64 (published constants), on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Shingles:
    """Hashes of the word shingles of a text; words are lower case, cut at white space."""

    def __init__(self, words: int = WORDS):
        self.words, self.memo = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """One hash per shingle, repeats included. A shorter text is one shingle of all its
        words; a text without words has none."""
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        words = (text or "").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
        h = np.array([memo[w] for w in words], np.uint64)
        n = min(self.words, len(h))
        out = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            out = mix(out + h[i:len(h) - n + 1 + i] + np.uint64(0x9E3779B97F4A7C15))
        return out

    def elements(self, text: str | None) -> np.ndarray:
        """The multiset as a set: the c-th repeat of a shingle is an element of its own, so
        the weighted Jaccard similarity is that of these sets."""
        h = np.sort(self(text))
        if not len(h):
            return h
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        repeat = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
        return mix(h + repeat.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


# Poisson(1) distribution function: darts in a unit tile.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])


def dart_signatures(elements: list[np.ndarray], k: int) -> np.ndarray:
    """Signatures (documents x k, uint64) of non-empty element sets. An element is a unit of
    weight of a shingle, so its region is one tile wide and rows of tiles stack upwards."""
    count = len(elements)
    sizes = np.array([len(e) for e in elements])
    signature = np.zeros((count, k), np.uint64)
    rank = np.full((count, k), np.inf)
    low = np.zeros(count, np.int64)
    high = np.maximum(1, np.ceil(k * (math.log(k) + 3.0) / sizes)).astype(np.int64)
    todo = np.arange(count)
    while len(todo):
        rows = high[todo] - low[todo]
        doc = np.repeat(todo, sizes[todo] * rows)
        element = np.concatenate([np.tile(elements[d], r) for d, r in zip(todo, rows)])
        row = np.concatenate([np.repeat(np.arange(low[d], high[d]), sizes[d]) for d in todo])
        tile = mix(element + mix(row.astype(np.uint64) + np.uint64(1)))
        darts = np.searchsorted(_POISSON, _unit(mix(tile + np.uint64(7))), side="right")
        at = np.repeat(np.arange(len(tile)), darts)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(tile[at] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        height = row[at] + _unit(mix(dart + np.uint64(11)))
        slot = doc[at] * k + (dart % np.uint64(k)).astype(np.int64)
        filled = np.isfinite(rank.reshape(-1)[slot])  # by lower rows: those darts came earlier
        dart, height, slot = dart[~filled], height[~filled], slot[~filled]
        flat = rank.reshape(-1)
        np.minimum.at(flat, slot, height)
        won = flat[slot] == height
        signature.reshape(-1)[slot[won]] = dart[won]
        todo = todo[~np.isfinite(rank[todo]).all(axis=1)]
        low[todo] = high[todo]
        high[todo] = 2 * high[todo]
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band (documents x bands, int64)."""
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        out = mix(out + signature[:, r::rows][:, :bands])
    return out.view(np.int64)


def _batched(texts, elements_of, budget: int = 400_000, k: int = BANDS * ROWS):
    """Groups of element sets whose darts fit in memory together."""
    group, cost = [], 0
    for i, t in enumerate(texts):
        e = elements_of(t)
        c = max(len(e), k * (math.log(k) + 3)) * 2
        if group and cost + c > budget:
            yield group
            group, cost = [], 0
        group.append((i, e))
        cost += c
    if group:
        yield group


def signed(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest (of the text), n (shingles), keys (band keys) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        np.seterr(over="ignore")
        shingles = Shingles(words)
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            keys: list = [np.zeros(0, np.int64)] * len(batch)
            for group in _batched(batch["text"], shingles.elements, k=bands * rows):
                full = [(i, e) for i, e in group if len(e)]
                if not full:
                    continue
                got = band_keys(dart_signatures([e for _, e in full], bands * rows), bands, rows)
                for (i, e), own in zip(full, got):
                    n[i], keys[i] = len(e), own
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "n": n,
                                "keys": keys})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id").cast("string"), text_digest("text").alias("digest"),
                       F.col("text").cast("string").alias("text")) \
               .mapInPandas(run, "doc_id string, digest binary, n long, keys array<long>") \
               .withColumn("doc_id", F.col("doc_id").cast(kind))


def _elements_udf(words: int):
    @F.pandas_udf("array<int>")
    def elements(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        np.seterr(over="ignore")
        shingles = Shingles(words)
        for texts in batches:
            # 32 bits are kept: two of n elements meet by chance with n^2 / 2^32, which
            # moves a similarity by 1 / n.
            yield pd.Series([(shingles.elements(t) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                             for t in texts])

    return elements


def _slim(df: DataFrame, *rows: int) -> DataFrame:
    """One partition if none of the tables that ``df`` joins or groups has more rows than a
    partition of theirs: Spark takes the result of a join for many partitions and would
    shuffle it, in as many tasks as the cluster shuffles into, before it is joined again."""
    return df.coalesce(1) if max(rows) <= SLIM_ROWS else df


def components(labels: DataFrame, links: DataFrame, nodes: int, folder: str | None = None
               ) -> DataFrame:
    """(node, comp) of the ``nodes`` rows of ``labels`` after the links (a, b) between nodes:
    every node takes the least comp of itself and its neighbours, then the comp of that
    node, until nothing changes. Hubs pre-aggregate; chains shorten by half in every round.
    The result stands under ``folder`` (default: one that is removed when the driver ends)."""
    folder = folder or scratch_path(labels.sparkSession, "components")
    both, ways, _ = rewritten(links.union(links.select("b", "a")).toDF("a", "b").distinct(),
                              folder, None, SLIM_ROWS)
    while True:
        near = _slim(merged(both, labels.select(F.col("node").alias("b"), "comp"), "b")
                     .groupBy("a").agg(F.min("comp").alias("least")), nodes, ways)
        hooked = _slim(merged(labels, near.withColumnRenamed("a", "node"), "node", "left")
                       .select("node", "comp", F.least("comp", "least").alias("to")), nodes, ways)
        ends = hooked.select(F.col("node").alias("to"), F.col("to").alias("end"))
        jumped, _, moved = rewritten(merged(hooked, ends, "to")
                                     .select("node", F.least("to", "end").alias("comp"),
                                             (F.least("to", "end") != F.col("comp")).alias("moved")),
                                     folder, "moved", SLIM_ROWS)
        labels = jumped.select("node", "comp")
        if not moved:
            return labels


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, leader) whose exact weighted Jaccard similarity reaches the bound."""
    own = sets.select("node", F.col("elements").alias("x"))
    led = sets.select(F.col("node").alias("leader"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return merged(merged(pairs, own, "node"), led, "leader") \
        .where(common >= similarity * (F.size("x") + F.size("y") - common) - _EPSILON) \
        .select("node", "leader")


def prefix_buckets(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(key, node, n, at, leads): the rarest elements of each of the given nodes with their
    places in the order of rarity, as many as must contain a shared one if two sets are
    similar: n - ceil(similarity * n) + 1. ``leads`` marks those of them that must contain
    one shared with a set at least as large: n - ceil(2 similarity / (1 + similarity) * n) + 1.
    So a similar pair always meets under a key that leads in the smaller set; documents
    that only share a frequent passage, or are far copies of one text, don't: the elements
    they share stand behind their own."""
    # Dealt by element at once: a table of few sets has one partition but many elements.
    own = merged(sets, nodes, "node", "left_semi") \
        .select("node", "n", F.explode("elements").alias("key")).repartition("key")
    spread = own.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    by_rarity = Window.partitionBy("node").orderBy("df", "key")  # one document's elements
    least = F.ceil(similarity * F.col("n") - _EPSILON)
    both = F.ceil(2 * similarity / (1 + similarity) * F.col("n") - _EPSILON)
    return merged(own, spread, "key").withColumn("at", F.row_number().over(by_rarity)) \
              .where((F.col("at") <= F.col("n") - least + 1) & (F.col("df") > 1)) \
              .select("key", "node", "n", "at", (F.col("at") <= F.col("n") - both + 1).alias("leads"))


def linked_nodes(buckets: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(node, comp): components of the similar pairs that share a bucket.

    ``buckets`` has (key, node) of buckets with more than one node, ``sets`` (node, n,
    elements). Each round takes leaders from every open bucket. The first round settles
    nearly everything; the nodes of the buckets that are still open then are dealt anew by
    their rarest elements, which no similar pair can miss."""
    folder = scratch_path(sets.sparkSession, "near-dedup")  # of the tables of all rounds
    comps = compact(_linked(buckets, sets, similarity, folder), SLIM_ROWS)
    remove_tree(sets.sparkSession, folder)
    return comps


def _linked(buckets: DataFrame, sets: DataFrame, similarity: float, folder: str) -> DataFrame:
    comps, nodes, _ = rewritten(sets.select("node", F.col("node").alias("comp")), folder, None,
                                SLIM_ROWS)
    rows, count, _ = rewritten(merged(buckets, sets.select("node", "n"), "node")
                               .select("key", "node", "n", F.lit(1).alias("at"),
                                       F.lit(True).alias("leads")), folder, None, SLIM_ROWS)
    leaders, round_ = 1, 1
    while True:
        # A row that has led was compared with all others of its bucket and is out of it.
        now = _slim(merged(rows, comps, "node"), count, nodes)
        open_ = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                       F.bool_or("leads").alias("any")) \
                   .where("lo <> hi and any").select("key")
        now, count, _ = rewritten(merged(now, _slim(open_, count, nodes), "key", "left_semi"),
                                  folder, None, SLIM_ROWS)
        if not count:
            return comps
        if round_ == 2:
            left = now.select("node").distinct()
            rows, count, _ = rewritten(prefix_buckets(left, sets, similarity), folder, None,
                                       SLIM_ROWS)
            round_ = 3
            continue
        first = F.struct("node", F.col("comp").alias("of"), "n", "at")
        if leaders == 1:  # a plain aggregate: pre-aggregated however large the bucket
            picked = now.where("leads").groupBy("key").agg(F.min(first).alias("l"))
        else:
            best = Window.partitionBy("key").orderBy("node")
            picked = now.where("leads").withColumn("_r", F.row_number().over(best)) \
                        .where(F.col("_r") <= leaders).select("key", first.alias("l"))
        picked = compact(picked.select("key", F.col("l.node").alias("leader"), "l.of",
                                       F.col("l.n").alias("m"), F.col("l.at").alias("lat")), SLIM_ROWS)
        # If this is the first element that two sets share, they share at most what stands
        # behind it in both; a similar pair is met under its first shared element.
        reach = 1 + F.least(F.col("n") - F.col("at"), F.col("m") - F.col("lat"))
        meet = (now["key"] == picked["key"]) & (F.col("comp") != F.col("of")) & \
               (reach >= similarity / (1 + similarity) * (F.col("n") + F.col("m")) - _EPSILON)
        pairs = merged(now, picked, meet) \
            .select(F.greatest("node", "leader").alias("node"),
                           F.least("node", "leader").alias("leader")).distinct()
        # The comparisons are the work of a round: never all of them in one task.
        found, links, _ = rewritten(_similar(pairs.repartition("node"), sets, similarity).toDF("a", "b"),
                                    folder, None, SLIM_ROWS)
        if links:
            comps = components(comps, found, nodes, folder)
        rows = _slim(merged(now.drop("comp"), picked.select("key", F.col("leader").alias("node")),
                            ["key", "node"], "left_anti"), count)
        round_ = max(round_, 2)
        leaders *= LEADERS


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, kept, text digest.

    Documents are linked when the weighted Jaccard similarity of their shingles reaches
    ``similarity``; classes are the connected components, ``class_id`` the least doc_id in
    the class, and that document is kept (one row of it, if rows repeat). Equal texts are
    one class; null and empty texts and texts without words are linked only to texts equal
    to them (null counts as empty). A null doc_id is larger than every other. Other
    columns don't matter; an empty table gives no rows.
    """
    state = compact(signed(docs.select("doc_id", "text"), words, bands, rows)
                    .withColumn("uid", F.monotonically_increasing_id()), WIDE_ROWS)
    # Equal texts are one node, named by its least row id.
    equal = compact(state.groupBy("digest").agg(F.min("uid").alias("node")))
    member = salted_join(state.select("uid", "doc_id", "digest"), equal, ["digest"], "uid")
    member = compact(member.select("uid", "doc_id", "digest", "node"), WIDE_ROWS)
    nodes = equal.select(F.col("node").alias("uid"))
    banded = merged(state.select("uid", "keys"), nodes, "uid") \
        .select(F.explode("keys").alias("key"), F.col("uid").alias("node"))
    shared = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")) \
                   .where("lo <> hi").select("key")
    buckets = compact(merged(banded, shared, "key", "left_semi"))
    wanted = buckets.select("node").distinct() \
                    .join(equal, "node").select("node", F.col("digest").alias("_digest"))
    wanted = compact(wanted)
    # The shingles of those nodes only: one text each.
    texts = docs.select(F.col("text").cast("string").alias("text"), text_digest("text").alias("_d")) \
                .join(wanted, F.col("_d") == F.col("_digest")) \
                .groupBy("node").agg(F.any_value("text").alias("text"))
    elements = _elements_udf(words)
    sets = compact(texts.select("node", elements("text").alias("elements"))
                   .withColumn("n", F.size("elements")), WIDE_ROWS)
    comps = linked_nodes(buckets, sets, similarity)
    classes = merged(member, comps, "node", "left") \
        .select("uid", "doc_id", "digest", F.coalesce("comp", "node").alias("comp"))
    classes = compact(classes, WIDE_ROWS)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"),
                           F.col("uid").alias("u")))
    heads = compact(classes.groupBy("comp").agg(first.alias("h"), F.count(F.lit(1)).alias("class_size")))
    return salted_join(classes, heads, ["comp"], "uid") \
        .select("doc_id", F.col("h.d").alias("class_id"), "class_size",
                (F.col("uid") == F.col("h.u")).alias("kept"), "digest")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, with the columns of ``docs``."""
    found = near_duplicates(docs, **options)
    return drop_rows(docs, found.select("doc_id", "digest", "kept"))
