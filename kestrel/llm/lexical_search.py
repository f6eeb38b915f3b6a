"""Ranked lexical search over hashed max-sketches, with exact results.

A document's impacts fold into a sketch of ``WIDTH`` coordinates: a term's place is a hash of
it, and a coordinate keeps the maximum of the impacts that fall there. What a query can score
in a document is then at most the sum, over its terms, of weight times the coordinate of the
term. For all queries of a block and all documents of a shard these bounds are one matrix
product (the batched lookup). A query's documents are rescored exactly in order of falling
bounds until the next bound is below the k-th best score.

The impact of a term depends on its occurrences tf in the document and on the length of the
document against the corpus; it rises with tf. So the sketch is kept as maxima of tf, and turned
into impacts once the corpus is counted: the index is built in one pass over the texts. Every
scan task writes its documents as shards of bounded size (sketches, term counts by document),
one row each; no text is shuffled. Queries come in blocks of bounded size; a block is broadcast,
document frequencies are summed over all shards, and a task keeps k documents per query.
Thresholds rise from shard to shard within a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import bucket_count, checkpointed, digest52, running_sum

WIDTH = 1024                 # coordinates of a sketch
SHARD_DOCS = 4096
SHARD_POSTINGS = 2_000_000
QUERY_TERMS = 200_000        # (query, term) pairs per block of queries
QUERIES_AT_ONCE = 256        # queries whose bounds are computed together
AT_ONCE = 32                 # documents rescored between two looks at the threshold, at first
K1_SCALE, LENGTH_SHARE = 8, 75   # saturation (8 per 100 words' worth) and weight of the length, in percent
ONE = 1_000_000_000

#: Terms of the UTF-8 bytes of a text: ASCII letters and digits and everything beyond ASCII.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, A-Z lower-cased (``bytes.lower`` touches no others)."""
    return _TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if isinstance(text, str) else []


def place(term: bytes) -> int:
    return crc32(term) % WIDTH


SHARDS = ("n_docs long, n_words long, n_filled long, ids binary, nameless binary, lengths binary, terms binary, "
          "starts binary, numbers binary, counts binary, sketch binary")


class _Builder:
    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.lengths, self.numbers, self.counts, self.sizes = [], [], [], [], []
        self.postings = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = Counter(terms_of(text))
        vocabulary = self.vocabulary
        self.numbers.append(np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in found), np.int32, len(found)))
        self.counts.append(np.fromiter(found.values(), np.int32, len(found)))
        self.sizes.append(len(found))
        self.ids.append(doc_id)
        self.lengths.append(int(self.counts[-1].sum()))
        self.postings += len(found)

    def full(self) -> bool:
        return self.postings >= SHARD_POSTINGS or len(self.ids) >= SHARD_DOCS

    def row(self) -> pd.DataFrame:
        numbers, counts = np.concatenate(self.numbers), np.concatenate(self.counts)
        places = np.fromiter((place(t) for t in self.vocabulary), np.int64, len(self.vocabulary))
        sketch = np.zeros(len(self.ids) * WIDTH, np.int32)
        own = np.repeat(np.arange(len(self.ids)), self.sizes)
        np.maximum.at(sketch, own * WIDTH + places[numbers], counts)
        filled = np.flatnonzero(sketch)  # kept sparse: short documents fill few coordinates
        return pd.DataFrame({
            "n_docs": [len(self.ids)], "n_words": [sum(self.lengths)], "n_filled": [int(np.count_nonzero(self.lengths))],
            "ids": [np.array([i or 0 for i in self.ids], np.int64).tobytes()],
            "nameless": [np.array([i is None for i in self.ids]).tobytes()],
            "lengths": [np.array(self.lengths, np.int64).tobytes()], "terms": [b"\n".join(self.vocabulary)],
            "starts": [np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64).tobytes()],
            "numbers": [numbers.tobytes()], "counts": [counts.tobytes()],
            "sketch": [np.concatenate([filled, sketch[filled]]).astype(np.int32).tobytes()]})


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The checkpointed shards of ``docs``: one row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = _Builder()
        for batch in batches:
            for doc_id, body in zip(batch["key"], batch["text"]):
                shard.add(int(doc_id) if isinstance(doc_id, str) else None, body)
                if shard.full():
                    yield shard.row()
                    shard = _Builder()
        if shard.ids:
            yield shard.row()

    return checkpointed(docs.select(F.col(key).cast("bigint").cast("string").alias("key"),
                                    F.col(text).cast("string").alias("text")).mapInPandas(run, SHARDS))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth in a document of norm ``m``, rounded down."""
    return (ONE * tf) // (1000 * tf + K1_SCALE * m)


class Block:
    """Queries that are searched together: their distinct terms, and per query the numbers
    and counts of its terms."""

    def __init__(self, queries: list[tuple[int, list[bytes], list[int]]]):
        self.names = [name for name, _, _ in queries]
        self.terms = sorted({t for _, terms, _ in queries for t in terms})
        self.index = {t: i for i, t in enumerate(self.terms)}
        self.queries = [(np.array([self.index[t] for t in terms], np.int64), np.array(counts, np.int64))
                        for _, terms, counts in queries]

    def numbers(self, terms: bytes) -> np.ndarray:
        """The block's number of every term of a shard; -1 for those no query has."""
        get = self.index.get
        return np.array([get(t, -1) for t in terms.split(b"\n")] if terms else [], np.int64)


class Shard:
    """A shard opened for a block of queries."""

    def __init__(self, row, block: Block, norm):
        self.ids, self.nameless = np.frombuffer(row.ids, np.int64), np.frombuffer(row.nameless, bool)
        self.m = norm(np.frombuffer(row.lengths, np.int64))
        starts = np.frombuffer(row.starts, np.int64)
        term = block.numbers(row.terms)[np.frombuffer(row.numbers, np.int32)]
        known = np.flatnonzero(term >= 0)
        own = np.repeat(np.arange(row.n_docs), np.diff(starts))[known]
        self.terms = term[known]
        self.impact = impacts(np.frombuffer(row.counts, np.int32)[known].astype(np.int64), self.m[own])
        self.starts = np.searchsorted(own, np.arange(row.n_docs + 1))
        at, tf = np.frombuffer(row.sketch, np.int32).reshape(2, -1).astype(np.int64)
        self.sketch = np.zeros((row.n_docs, WIDTH))
        self.sketch[at // WIDTH, at % WIDTH] = impacts(tf, self.m[at // WIDTH])

    def scores(self, docs: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of some documents under the weights of one query."""
        lens = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(lens)
        at = np.arange(ends[-1]) + np.repeat(self.starts[docs] - (ends - lens), lens)
        sums = np.concatenate([[0], np.cumsum(weight_of[self.terms[at]] * self.impact[at])])
        return sums[ends] - sums[ends - lens]


def _best(score: np.ndarray, ids: np.ndarray, nameless: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0; ties by id, those without id last."""
    some = np.flatnonzero(score > 0)
    return some[np.lexsort((ids[some], nameless[some], -score[some]))][:k]


def search_shard(shard: Shard, block: Block, weights: np.ndarray, best: dict[int, tuple], k: int) -> tuple[int, int]:
    """Bring ``best`` (query -> scores, ids, nameless) up to date with one shard. Returns how
    many documents were rescored, and how many there are for all queries together."""
    places = np.array([place(t) for t in block.terms], np.int64)
    weight_of = np.zeros(len(block.terms), np.int64)
    rescored = 0
    for first in range(0, len(block.queries), QUERIES_AT_ONCE):
        queries = block.queries[first:first + QUERIES_AT_ONCE]
        table = np.zeros((WIDTH, len(queries)))
        for q, (terms, counts) in enumerate(queries):
            np.add.at(table[:, q], places[terms], (weights[terms] * counts).astype(np.float64))
        bounds = (shard.sketch @ table).T * (1 + 1e-9)  # doubles round sums above 2^53
        for q, (terms, counts) in enumerate(queries):
            score, ids, nameless = best.get(first + q, (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)))
            least = int(score[-1]) if len(score) == k else 1
            may = np.flatnonzero(bounds[q] >= least)
            order = may[np.argsort(-bounds[q][may], kind="stable")]
            weight_of[terms] = weights[terms] * counts
            at, step = 0, AT_ONCE
            while at < len(order) and bounds[q][order[at]] >= least:
                docs = order[at:at + step]
                found = (shard.scores(docs, weight_of), shard.ids[docs], shard.nameless[docs])
                score, ids, nameless = (np.concatenate(both) for both in zip((score, ids, nameless), found))
                kept = _best(score, ids, nameless, k)
                score, ids, nameless = score[kept], ids[kept], nameless[kept]
                least = int(score[-1]) if len(score) == k else 1
                rescored += len(docs)
                at, step = at + step, 2 * step
            weight_of[terms] = 0
            best[first + q] = (score, ids, nameless)
    return rescored, len(shard.m) * len(block.queries)


def _frequencies(index: DataFrame, shared) -> np.ndarray:
    """Documents of the corpus that hold each term of the block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = shared.value
        df = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for terms, numbers in zip(batch["terms"], batch["numbers"]):
                number = block.numbers(terms)
                count = np.bincount(np.frombuffer(numbers, np.int32), minlength=len(number))
                df[number[number >= 0]] += count[number >= 0]
        has = np.flatnonzero(df)
        yield pd.DataFrame({"term": has, "df": df[has]})

    rows = index.select("terms", "numbers").mapInPandas(run, "term long, df long") \
                .groupBy("term").agg(F.sum("df").alias("df")).collect()  # a row per term of the block
    out = np.zeros(len(shared.value.terms), np.int64)
    for r in rows:
        out[r.term] = r.df
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def _search_block(index: DataFrame, queries: list, k: int, n_docs: int, n_words: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    shared = context.broadcast(Block(queries))
    weights = context.broadcast(term_weights(_frequencies(index, shared), n_docs))

    def norm(lengths: np.ndarray) -> np.ndarray:
        """100 for a document of average length, at least ``100 - LENGTH_SHARE``."""
        return 100 - LENGTH_SHARE + np.array([LENGTH_SHARE * n * n_docs // max(1, n_words) for n in lengths.tolist()],
                                             np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                search_shard(Shard(row, shared.value, norm), shared.value, weights.value, best, k)
        for q, (score, ids, nameless) in best.items():
            named = [None if none else i for i, none in zip(ids.tolist(), nameless)]
            yield pd.DataFrame({"query": shared.value.names[q], "doc_id": pd.Series(named, dtype=object), "score": score})

    found = index.mapInPandas(run, "query bigint, doc_id bigint, score bigint")
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = checkpointed(found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k))
    shared.destroy()
    weights.destroy()
    return best


def query_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """query, key, terms, counts and n (distinct terms) of each distinct item with a term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [Counter(terms_of(t)) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "terms": [sorted(c) for c in found],
                                "counts": [[c[t] for t in sorted(c)] for c in found], "n": [len(c) for c in found]})

    kind = items.schema[key].dataType.simpleString()
    return items.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")) \
                .dropDuplicates().mapInPandas(run, "key string, terms array<binary>, counts array<int>, n long") \
                .where("n > 0").withColumn("query", F.monotonically_increasing_id()) \
                .withColumn("key", F.col("key").cast(kind))


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", terms_per_block: int = QUERY_TERMS) -> DataFrame:
    """item_key, rank, doc_id, score: for every item the k rows of ``docs`` that score
    highest, above 0; equal scores by ascending id, null ids last.

    Ids of documents are integers. Null texts have no terms: such documents are never found
    and count in no statistic, such items have no rows. Repeated documents are found as often as
    they occur; a repeated item (same key and text) asks once, and items that share a key but
    not the text each get their own ranks. Texts of any length are read whole, other columns
    are ignored, empty tables give no rows. Every block of items is searched, written and its
    broadcasts removed before the next.
    """
    index = build_index(docs, key, text)
    stats = index.agg(F.sum("n_filled").alias("n"), F.sum("n_words").alias("l")).first()
    asked = checkpointed(query_terms(items, item_key, item_text))
    sizes = asked.select("query", "n", digest52(F.col("query").cast("string")).alias("_h"), F.lit(0).alias("_all"))
    blocks = checkpointed(running_sum(sizes, "_all", "_h", ["query"], "n", "before", bucket_count(sizes.count()))
                          .select("query", F.floor(F.col("before") / terms_per_block).alias("block")))
    out = None
    for block in range(1 + (blocks.agg(F.max("block")).first()[0] or 0)):
        # Bounded by ``terms_per_block``, and one query more.
        rows = asked.join(blocks.where(F.col("block") == block), "query").orderBy("query").collect()
        part = _search_block(index, [(r["query"], [bytes(t) for t in r.terms], r.counts) for r in rows], k,
                             int(stats.n or 0), int(stats.l or 0))
        out = part if out is None else out.unionByName(part)
    return out.join(asked.select("query", F.col("key").alias(item_key)), "query") \
              .select(item_key, "rank", "doc_id", "score")


def terms_column(text: str | Column) -> Column:
    """The same terms as a column of strings (for reports and tests)."""
    text = F.col(text) if isinstance(text, str) else text
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, lower),
                                F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
