"""Reproducible splits and samples.

Every draw is a function of ``md5(seed || ':' || row_key)``, so the same rows are
chosen whatever the partitioning, the number of executors or a task retry, and the
same rule can be written in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ordering import global_rank
from kestrel.session import materialize

_PREFIX = 4  # hex digits of a digest


def row_hash(key: Column | str, seed: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def hash_bucket_key(h: Column) -> Column:
    """First 48 bits of the hex digest as a number: exact in a double and
    non-decreasing along the digest's string order."""
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double")


def split_threshold(train_fraction: float) -> str:
    """Four hex digits t with P(prefix < t) ~= train_fraction."""
    return format(min(0xFFFF, math.ceil(train_fraction * 0x10000)), "04x")


def random_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 0,
                 split_col: str = "split") -> DataFrame:
    """Approximate split (R1): ``train`` when the hash prefix is under the threshold.

    Unlike ``randomSplit`` it needs no sort and does not change with the partitioning.
    """
    h = F.substring(row_hash(key, seed), 1, 4)
    return df.withColumn(split_col, F.when(h < F.lit(split_threshold(train_fraction)),
                                           F.lit("train")).otherwise(F.lit("test")))


def hash_order(df: DataFrame, key: str, seed: int, rank_col: str = "draw",
               count_col: str | None = None) -> DataFrame:
    """Rank rows by their seeded hash (ties broken by the key), computed two-phase.

    The digest of a unique key is uniform, so equal-width ranges of its first 48 bits
    are balanced buckets without sampling the data for quantiles first.
    """
    from kestrel.operators.ordering import default_buckets
    nb = default_buckets(df)
    d = df.withColumn("_h", row_hash(key, seed))
    bucket = F.floor(hash_bucket_key(F.col("_h")) * F.lit(nb / float(1 << 48))).cast("int")
    r = global_rank(d, [F.col("_h"), F.col(key).cast("string")], rank_col,
                    count_col=count_col, bucket=bucket)
    return r.drop("_h")


def hash_cuts(df: DataFrame, key: str, seed: int, positions: Sequence[int],
              digested: bool = False) -> list[tuple[str, str] | None]:
    """Where a hash order is cut: for each position the (digest, key) of the row that has
    this rank; None beyond the last row.

    One aggregation counts the rows per digest prefix (at most 65,536 counts reach the
    driver, whatever the table); only the rows of the prefixes in which a position falls
    are ranked. No row of the table is shuffled for the others. ``digested``: ``df`` has
    the columns of ``with_digest``.
    """
    if not digested:
        df = with_digest(df.select(key), key, seed)
    h, name = F.col("_h"), F.col("_k")
    counts = df.groupBy(F.substring(h, 1, _PREFIX).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    wanted: dict[str, dict[int, list[int]]] = {}
    below, todo = 0, sorted((p, i) for i, p in enumerate(positions))
    out: list[tuple[str, str] | None] = [None] * len(positions)
    at = 0
    for prefix, n in sorted((r.p, r.n) for r in counts):
        while at < len(todo) and todo[at][0] <= below + n:
            position, i = todo[at]
            if position <= below:
                out[i] = ("", "")  # before the first row
            else:
                wanted.setdefault(prefix, {}).setdefault(position - below, []).append(i)
            at += 1
        below += n
    if wanted:
        some = df.select(h.alias("h"), name.alias("k")).where(F.substring("h", 1, _PREFIX).isin(list(wanted)))
        order = Window.partitionBy(F.substring("h", 1, _PREFIX)).orderBy("h", "k")
        ranks = sorted({r for v in wanted.values() for r in v})
        for r in some.withColumn("r", F.row_number().over(order)).where(F.col("r").isin(ranks)).collect():
            for i in wanted[r.h[:_PREFIX]].get(r.r, ()):
                out[i] = (r.h, r.k)
    return out


def with_digest(df: DataFrame, key: str, seed: int, digest: str = "_h", name: str = "_k") -> DataFrame:
    """``df`` with the digest and the name that order a row. Spark doesn't merge a projection
    into one that names its expressions often, so the digest is computed once per row."""
    return df.select("*", F.coalesce(row_hash(key, seed), F.lit("")).alias(digest),
                     F.coalesce(F.col(key).cast("string"), F.lit("")).alias(name))


def count_before(cuts: Sequence[tuple[str, str]], lo: int, hi: int, h: Column, k: Column) -> Column:
    """How many of the sorted cuts in [lo, hi) lie before the row (digest, name), as a
    balanced tree of comparisons."""
    if lo >= hi:
        return F.lit(0)
    mid = (lo + hi) // 2
    digest, name = (F.lit(v) for v in cuts[mid])
    before = (h > digest) | ((h == digest) & (k > name))
    return F.when(before, F.lit(mid - lo + 1) + count_before(cuts, mid + 1, hi, h, k)) \
            .otherwise(count_before(cuts, lo, mid, h, k))


def up_to(cut: tuple[str, str] | None, key: str, seed: int) -> Column:
    """Whether a row stands at or before a cut of ``hash_cuts``; names the digest twice, see
    ``with_digest``."""
    return at_or_before(cut, F.coalesce(row_hash(key, seed), F.lit("")),
                        F.coalesce(F.col(key).cast("string"), F.lit("")))


def at_or_before(cut: tuple[str, str] | None, h: Column, k: Column) -> Column:
    """``up_to`` for a row's digest and name in columns."""
    if cut is None:
        return F.lit(True)
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (k <= F.lit(cut[1])))


def exact_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42,
                split_col: str = "split", written: bool = False) -> DataFrame:
    """Exactly ceil(test_fraction * n) test rows (R2): the first ones in hash order. Only
    the rows around the boundary are ranked; every other row compares its hash. ``written``
    checkpoints the rows with their digests first: for narrow rows that are read often."""
    d = with_digest(df, key, seed)
    if written:
        d = materialize(d)
    n_test = math.ceil(df.count() * test_fraction)
    cut = hash_cuts(d, key, seed, [n_test], digested=True)[0]
    return d.withColumn(split_col, F.when(at_or_before(cut, F.col("_h"), F.col("_k")), F.lit("test"))
                        .otherwise(F.lit("train"))).drop("_h", "_k")


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42,
             rank_col: str = "draw") -> DataFrame:
    """Exactly min(n, rows) rows without replacement (R3). Features and label are drawn
    as one row, so they stay paired. Only the drawn rows are ranked."""
    cut = hash_cuts(df, key, seed, [n])[0]
    some = with_digest(df, key, seed).where(at_or_before(cut, F.col("_h"), F.col("_k"))).drop("_h", "_k")
    return hash_order(some, key, seed, rank_col)


def size_schedule(df: DataFrame, chunks: int, min_size: int, max_size: int) -> DataFrame:
    """Sample sizes ``min + (i+1) * floor((n - min) / chunks)`` with
    ``n = min(rows, max)`` (R4); ``rows`` is counted by Spark. With fewer rows than
    ``min_size`` the step is 0, as in the learning curve."""
    n = F.least(F.col("_rows"), F.lit(max_size))
    step = F.greatest(F.lit(0), F.floor((n - F.lit(min_size)) / F.lit(chunks))).cast("long")
    return (df.agg(F.count(F.lit(1)).alias("_rows"))
              .select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
                      .alias("chunk"),
                      step.alias("_step"))
              .select("chunk", (F.lit(min_size) + (F.col("chunk") + 1) * F.col("_step"))
                      .cast("long").alias("size")))
