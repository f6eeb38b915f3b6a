"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking.

A vector is scaled to length 1 and turned by a pseudo-rotation: three rounds of random signs
and a fast Hadamard transform. Its code in a table is the signed axis nearest to the turned
vector, one of twice the dimension (padded to a power of two). ``TABLES`` tables turn
differently. Every scan task hashes its vectors and writes them as shards (vectors, ids, the
rows of each bucket), one row each; no vector is shuffled.

Queries come in blocks of bounded size. A block is broadcast, and each shard collects, for a
query, the rows of its ``PROBES`` best buckets: all signed axes of all tables are ranked by the
coordinate that the turned query has there, so a table whose second axis is close is probed
twice and one that says little not at all. While a shard gave fewer than ``LEAST`` candidates
(all rows, if it has fewer) the next buckets are taken. Candidates are ranked by their exact
Euclidean distance, in double precision on the original vectors; a task keeps k per query,
and only those are shuffled. A bucket is never moved to one task: a vector that a third
of all rows share is spread over the shards as it was over the scan.

The hash looks at directions only. On tables whose vectors differ much in length, measure the
recall (``search(.., probes=None)`` is the exact answer) and raise ``probes`` if need be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import bucket_count, checkpointed, digest52, running_sum

TABLES = 64
PROBES = 64                  # buckets a query looks into, of all tables together
LEAST = 1024                 # candidates a shard gives at least
SHARD_NUMBERS = 1 << 20      # components of the vectors of a shard (at least LEAST vectors)
QUERIES_AT_ONCE = 256        # queries turned together
QUERY_NUMBERS = 1 << 20      # components of the queries of a block
SEED = 12


def _signs(dim: int, table: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, table]).choice(np.float32([-1, 1]), (3, dim, 1))


def turned(units: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of a table, of columns (dimension x vectors, a power of two)."""
    dim = len(units)
    x = units
    for signs in _signs(dim, table):
        x = x * signs
        half = 1
        while half < dim:
            pairs = x.reshape(dim // (2 * half), 2, half, -1)
            x = np.concatenate([pairs[:, :1] + pairs[:, 1:], pairs[:, :1] - pairs[:, 1:]], axis=1)
            half *= 2
        x = x.reshape(dim, -1) * np.float32(dim ** -0.5)
    return x


def unit_columns(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, as columns padded with zeros to a power of two."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # first: squares of large components overflow
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    out = np.zeros((1 << (v.shape[1] - 1).bit_length(), len(v)), np.float32)
    out[:v.shape[1]] = v.T
    return out


def nearest_axes(columns: np.ndarray) -> np.ndarray:
    """Twice the number of the largest coordinate, plus one where it is negative."""
    axis = np.abs(columns).argmax(axis=0)
    return 2 * axis + (columns[axis, np.arange(columns.shape[1])] < 0)


def usable(lists: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors by dimension; null, empty and zero vectors and those with null
    or non-finite components are left out."""
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)  # null components become NaN
    dims = np.diff(offsets)
    out = {}
    for dim in np.unique(dims[dims > 0]).tolist():
        rows = np.flatnonzero((dims == dim) & lists.is_valid().to_numpy(zero_copy_only=False))
        vectors = flat[offsets[:-1][rows][:, None] + np.arange(dim)]
        good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
        if good.any():
            out[dim] = rows[good], vectors[good]
    return out


SHARDS = "dim int, ids binary, nameless binary, vectors binary, width int, rows binary, starts binary"


def _shard(dim: int, ids: list, vectors: np.ndarray) -> pa.RecordBatch:
    units = unit_columns(vectors)
    axes = 2 * len(units)
    rows = np.empty((TABLES, len(vectors)), np.uint16)
    starts = np.zeros((TABLES, axes + 1), np.int32)
    for t in range(TABLES):
        codes = nearest_axes(turned(units, t))
        rows[t] = np.argsort(codes, kind="stable")
        starts[t, 1:] = np.cumsum(np.bincount(codes, minlength=axes))
    nameless = np.array([i is None for i in ids])
    numbers = np.array([i or 0 for i in ids], np.int64)
    return pa.RecordBatch.from_pydict({
        "dim": pa.array([dim], pa.int32()), "ids": [numbers.tobytes()], "nameless": [nameless.tobytes()],
        "vectors": [vectors.tobytes()], "width": pa.array([vectors.dtype.itemsize], pa.int32()),
        "rows": [rows.tobytes()], "starts": [starts.tobytes()]})


def build_index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The checkpointed shards of all usable vectors (an array of floats or doubles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            ids = batch.column(0)
            for dim, (rows, found) in usable(batch.column(1)).items():
                names, parts = waiting.setdefault(dim, ([], []))
                names += ids.take(pa.array(rows)).to_pylist()
                parts.append(found)
                size = min(1 << 16, max(LEAST, SHARD_NUMBERS // dim))  # rows are kept in 16 bits
                if len(names) >= size:
                    whole = np.concatenate(parts)
                    full = len(names) - len(names) % size
                    for at in range(0, full, size):
                        yield _shard(dim, names[at:at + size], whole[at:at + size])
                    waiting[dim] = names[full:], [whole[full:]]
        for dim, (names, parts) in waiting.items():
            if names:
                yield _shard(dim, names, np.concatenate(parts))

    return checkpointed(vectors.select(F.col(key).cast("bigint"), F.col(vector)).mapInArrow(run, SHARDS))


class Queries:
    """The queries of one dimension in a block, with their buckets by falling coordinate."""

    def __init__(self, dim: int, ids: list[int], vectors: list[list[float]], probes: int | None):
        self.ids, self.vectors, self.probes = ids, np.array(vectors, np.float64), probes
        self.axes = 2 * len(unit_columns(self.vectors[:1]))
        n = min(probes or 1, TABLES * self.axes)
        self.first = np.empty((len(ids), n), np.int64)
        for at in range(0, len(ids), QUERIES_AT_ONCE):
            self.first[at:at + QUERIES_AT_ONCE] = np.argpartition(-self._close(at, at + QUERIES_AT_ONCE), n - 1, axis=1)[:, :n]

    def _close(self, lo: int, hi: int) -> np.ndarray:
        """The coordinate of some queries on every signed axis, table after table."""
        columns = unit_columns(self.vectors[lo:hi])
        close = np.empty((columns.shape[1], TABLES, self.axes), np.float32)
        for t in range(TABLES):
            at = turned(columns, t).T
            close[:, t, 0::2], close[:, t, 1::2] = at, -at
        return close.reshape(len(close), -1)

    def candidates(self, q: int, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Row numbers of a shard in the buckets that query ``q`` looks into."""
        size = rows.shape[1]
        if self.probes is None or size <= LEAST:
            return np.arange(size)
        taken = np.zeros(size, bool)
        chosen, ranked, done = self.first[q], None, len(self.first[q])
        while True:
            for t, axis in zip((chosen // self.axes).tolist(), (chosen % self.axes).tolist()):
                taken[rows[t, starts[t, axis]:starts[t, axis + 1]]] = True
            found = np.flatnonzero(taken)
            if len(found) >= LEAST or done >= TABLES * self.axes:
                return found
            ranked = np.argsort(-self._close(q, q + 1)[0], kind="stable") if ranked is None else ranked
            chosen, done = ranked[done:2 * done], 2 * done


def _nearest(distances: np.ndarray, ids: np.ndarray, nameless: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least distances; ties by id, those without id last."""
    some = np.arange(len(distances))
    if len(some) > k:
        some = np.flatnonzero(distances <= np.partition(distances, k - 1)[k - 1])
    return some[np.lexsort((ids[some], nameless[some], distances[some]))][:k]


def _search_block(index: DataFrame, rows: list, k: int, probes: int | None) -> DataFrame:
    block: dict[int, tuple[list, list]] = {}
    for r in rows:
        ids, vectors = block.setdefault(len(r.vector), ([], []))
        ids.append(r.query_id)
        vectors.append(list(r.vector))
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked: dict[int, Queries] = {}
        best: dict[int, tuple] = {}
        for batch in batches:
            for shard in batch.itertuples(index=False):
                if shard.dim not in shared.value:
                    continue
                if shard.dim not in asked:
                    asked[shard.dim] = Queries(shard.dim, *shared.value[shard.dim], probes)
                queries = asked[shard.dim]
                ids, nameless = np.frombuffer(shard.ids, np.int64), np.frombuffer(shard.nameless, bool)
                vectors = np.frombuffer(shard.vectors, f"f{shard.width}").reshape(len(ids), shard.dim)
                buckets = np.frombuffer(shard.rows, np.uint16).reshape(TABLES, len(ids))
                starts = np.frombuffer(shard.starts, np.int32).reshape(TABLES, -1)
                for q, query_id in enumerate(queries.ids):
                    at = queries.candidates(q, buckets, starts)
                    at = at[nameless[at] | (ids[at] != query_id)]
                    apart = vectors[at].astype(np.float64) - queries.vectors[q]
                    found = (np.sqrt((apart * apart).sum(axis=1)), ids[at], nameless[at])
                    if query_id in best:
                        found = tuple(np.concatenate(both) for both in zip(best[query_id], found))
                    kept = _nearest(*found, k)
                    best[query_id] = tuple(part[kept] for part in found)
        for query_id, (score, ids, nameless) in best.items():
            named = [None if none else i for i, none in zip(ids.tolist(), nameless)]
            yield pd.DataFrame({"query_id": query_id, "vec_id": pd.Series(named, dtype=object), "score": score})

    found = index.mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    by = Window.partitionBy("query_id").orderBy("score", F.asc_nulls_last("vec_id"))
    best = checkpointed(found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k))
    shared.destroy()
    return best


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, probes: int | None = PROBES,
           key: str = "vec_id", vector: str = "embedding", numbers_per_block: int = QUERY_NUMBERS) -> DataFrame:
    """query_id, rank, vec_id, score: for every id of ``queries`` the k nearest rows of
    ``vectors`` that were found (all, if fewer), by Euclidean distance.

    ``probes`` None compares every row: the exact answer. Ids are integers; a row with the
    query's id is no candidate of it. Vectors null, empty, zero or with null or non-finite
    components take no part on either side, and a query only meets vectors of its own
    dimension. Equal distances go by id, null ids last; a null id asks nothing. Repeated
    rows are found as often as they occur; of queries with one id and several vectors
    the least vector asks. Other columns are ignored; empty tables give no rows. Every block of
    queries is searched, written and its broadcast removed before the next.
    """
    index = build_index(vectors, key, vector)
    v = F.col(vector).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    asked = queries.where(F.col(key).isNotNull() & whole & F.exists(v, lambda x: x != 0)) \
                   .groupBy(F.col(key).cast("bigint").alias("query_id")).agg(F.min(v).alias("vector"))
    asked = checkpointed(asked.withColumn("_n", F.size("vector").cast("long"))
                         .withColumn("_h", digest52(F.col("query_id").cast("string"))).withColumn("_all", F.lit(0)))
    placed = checkpointed(running_sum(asked, "_all", "_h", ["query_id"], "_n", "before", bucket_count(asked.count()))
                          .select("query_id", "vector", F.floor(F.col("before") / numbers_per_block).alias("block")))
    out = None
    for block in range(1 + (placed.agg(F.max("block")).first()[0] or 0)):
        # Bounded by ``numbers_per_block``, and one query more.
        rows = placed.where(F.col("block") == block).orderBy("query_id").collect()
        part = _search_block(index, rows, k, probes)
        out = part if out is None else out.unionByName(part)
    return out.select("query_id", "rank", "vec_id", "score")


def is_query(key: str | Column = "vec_id") -> Column:
    """The stated query set: ids divisible by 100."""
    return (F.col(key) if isinstance(key, str) else key) % 100 == 0
