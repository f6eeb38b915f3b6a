"""Running sums and ranks over a global order without a single-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task. The
two-phase scan below splits the order into range buckets taken from approximate
quantiles of the order key, computes running sums inside each bucket in parallel, and
adds the exclusive prefix of the bucket totals (at most ``buckets`` rows per group).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir

_BK = "_bucket_key"
_B = "_bucket"


# Above this many cut points the bucket is found by Spark ML's Bucketizer (a JVM binary
# search) instead of an inline CASE tree, which must stay small enough for codegen.
_CASE_TREE_MAX = 255


# A table of one row per group or bucket is broadcast up to so many rows (counted).
_BROADCAST_ROWS = 100_000


def default_buckets(df: DataFrame) -> int:
    """About a quarter of the square root of the rows: buckets and the totals of all
    buckets grow alike with the data, whatever the session's settings."""
    return max(2, math.isqrt(df.count()) // 4)


def _broadcast_small(df: DataFrame) -> DataFrame:
    """``df`` (a checkpoint) marked for broadcast if it has few rows; else left to Spark."""
    return F.broadcast(df) if df.count() <= _BROADCAST_ROWS else df


def _count_below(cut, lo: int, hi: int, key: Column) -> Column:
    """Number of sorted cut points in positions [lo, hi) that are below ``key``, as a
    balanced tree of CASE expressions: log2(hi - lo) comparisons per row, and plain
    code-generated expressions (no lambda that would re-evaluate ``key``)."""
    if lo >= hi:
        return F.lit(0)
    mid = (lo + hi) // 2
    return F.when(cut(mid) < key, F.lit(mid - lo + 1) + _count_below(cut, mid + 1, hi, key)) \
            .otherwise(_count_below(cut, lo, mid, key))


def _assign_buckets(df: DataFrame, key: Column, partition_cols: Sequence[str],
                    buckets: int) -> DataFrame:
    """Add ``_bucket``: a range bucket that never decreases along ``key``."""
    d = df.withColumn(_BK, key.cast("double"))
    probs = [i / buckets for i in range(1, buckets)]
    if not probs:
        return d.drop(_BK).withColumn(_B, F.lit(0))
    if not partition_cols:
        # A bounded list of at most buckets-1 cut points, like QuantileDiscretizer; the
        # rank error shrinks with the bucket width so buckets stay balanced.
        rel_err = min(0.001, 0.25 / buckets)
        cuts = sorted({q for q in d.approxQuantile(_BK, probs, rel_err) if q == q})
        if len(cuts) > _CASE_TREE_MAX:
            from pyspark.ml.feature import Bucketizer
            splits = [float("-inf"), *cuts, float("inf")]
            # Bucketizer puts x in [s_i, s_i+1); any monotone assignment will do.
            d = Bucketizer(splits=splits, inputCol=_BK, outputCol="_bf",
                           handleInvalid="keep").transform(d)
            d = d.withColumn(_B, F.col("_bf").cast("int")).drop("_bf")
        else:
            d = d.withColumn(_B, _count_below(lambda i: F.lit(float(cuts[i])), 0, len(cuts),
                                              F.col(_BK)))
    else:
        # Per-group cut points travel with the rows; their count is capped so the
        # inline search stays small.
        if len(probs) > _CASE_TREE_MAX:
            step = (len(probs) + 1) / (_CASE_TREE_MAX + 1)
            probs = [probs[int(round(step * (i + 1))) - 1] for i in range(_CASE_TREE_MAX)]
        cuts = d.groupBy(*partition_cols).agg(
            F.percentile_approx(_BK, probs, 10000).alias("_cuts"))
        # The merged sketch can depend on the order partial results arrive in; both
        # plan branches below (and any task retry) must see the same cut points, so
        # the small table (one row per group) is checkpointed in the shared folder.
        ensure_checkpoint_dir(d.sparkSession)
        cuts = _broadcast_small(cuts.checkpoint(eager=True))
        # percentile_approx returns len(probs) sorted values per group.
        cuts = cuts.select(*[F.col(c).alias(f"_c_{c}") for c in partition_cols], "_cuts")
        # Broadcast, so that the rows aren't shuffled by the group key alone.
        cond = [d[c].eqNullSafe(cuts[f"_c_{c}"]) for c in partition_cols]
        d = (d.join(cuts, cond, "left").drop(*[f"_c_{c}" for c in partition_cols])
              .withColumn(_B, _count_below(lambda i: F.element_at("_cuts", i + 1), 0,
                                           len(probs), F.col(_BK)))
              .drop("_cuts"))
    return d.drop(_BK)


def running_sums(df: DataFrame, order: Sequence[str | Column], sums: Sequence[str],
                 partition_cols: Sequence[str] = (), bucket_key: Column | None = None,
                 buckets: int | None = None, bucket: Column | None = None,
                 keep_bucket: str | None = None) -> DataFrame:
    """Add ``run_<c>`` (inclusive running sum along ``order``) and ``tot_<c>`` (group
    total) for each column ``c`` of ``sums``.

    ``order`` must be a total order within each group (append a unique key). The first
    order column, or ``bucket_key``, must be numeric and non-decreasing along the order;
    it only decides how the work is split, never the result.

    ``bucket`` may give the bucket directly (an int column, non-decreasing along the
    order), e.g. equal-width ranges of a uniform hash; the quantile pass is then skipped.
    ``keep_bucket`` names a column for the bucket, for ``neighbours``.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    key = bucket_key if bucket_key is not None else order_cols[0]
    nb = buckets or default_buckets(df)
    d = df.withColumn(_B, bucket) if bucket is not None else \
        _assign_buckets(df, key, partition_cols, nb)
    # A provably non-null bucket: otherwise the join below makes Catalyst infer
    # ``isnotnull(bucket)`` and push that (hash and all) into the scan, computing it twice.
    d = d.withColumn(_B, F.coalesce(F.col(_B).cast("int"), F.lit(0)))
    pc = list(partition_cols)

    inner = Window.partitionBy(*pc, _B).orderBy(*order_cols) \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select("*", *[F.sum(c).over(inner).alias(f"_in_{c}") for c in sums])

    # Bucket totals: at most ``nb`` rows per group, so the windows below stay small.
    tot = d.groupBy(*pc, _B).agg(*[F.sum(c).alias(f"_bt_{c}") for c in sums])
    before = Window.partitionBy(*pc).orderBy(_B) \
                   .rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*pc)
    tot = tot.select(*pc, _B,
                     *[F.coalesce(F.sum(f"_bt_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
                       for c in sums],
                     *[F.sum(f"_bt_{c}").over(whole).alias(f"tot_{c}") for c in sums])
    if not pc:
        tot = F.broadcast(tot)  # at most ``nb`` rows by construction
        out = d.join(tot, [_B])
    else:
        # Null-safe on the group keys: a null group is a group too. ``d`` is already dealt by
        # (group, bucket); a broadcast of the totals spares it a second shuffle.
        ensure_checkpoint_dir(d.sparkSession)
        tot = _broadcast_small(tot.checkpoint(eager=True))
        t = tot.select(*[F.col(c).alias(f"_g_{c}") for c in pc], F.col(_B).alias("_g_b"),
                       *[c for c in tot.columns if c not in pc and c != _B])
        cond = [d[c].eqNullSafe(t[f"_g_{c}"]) for c in pc] + [d[_B] == t["_g_b"]]
        out = d.join(t, cond)
    return out.select(
        *[d[c] for c in d.columns if not c.startswith("_in_") and c != _B],
        *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"run_{c}") for c in sums],
        *[F.col(f"tot_{c}") for c in sums],
        *([d[_B].alias(keep_bucket)] if keep_bucket else []),
    )


def neighbours(df: DataFrame, by: Sequence[str], bucket: str, key: str, values: Sequence[str]) -> DataFrame:
    """Add, along ``key`` within a group, ``above`` (the next higher key) and ``below_<v>`` (the
    values of the next lower one); null at the ends. Rows of a bucket are compared in one
    window; buckets, ranges of the key, exchange their first and last row."""
    d = df
    inner = Window.partitionBy(*by, bucket).orderBy(key)
    d = d.select("*", F.lead(key).over(inner).alias("_up"),
                 *[F.lag(v).over(inner).alias(f"_down_{v}") for v in values],
                 F.row_number().over(inner).alias("_place"))
    last = F.max(F.struct(F.col(key), *[F.col(v) for v in values]))
    edges = df.groupBy(*by, bucket).agg(F.min(key).alias("_low"), last.alias("_last"))
    along = Window.partitionBy(*by).orderBy(bucket)  # a row per bucket
    edges = edges.select(*[F.col(c).alias(f"_e_{c}") for c in by], F.col(bucket).alias("_e"),
                         F.lead("_low").over(along).alias("_next"),
                         *[F.lag(f"_last.{v}").over(along).alias(f"_before_{v}") for v in values])
    on = [d[c].eqNullSafe(edges[f"_e_{c}"]) for c in by] + [d[bucket] == edges["_e"]]
    return d.join(edges, on).select(
        *[d[c] for c in df.columns], F.coalesce("_up", "_next").alias("above"),
        *[F.when(F.col("_place") > 1, F.col(f"_down_{v}")).otherwise(F.col(f"_before_{v}")).alias(f"below_{v}")
          for v in values])


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "rank",
                partition_cols: Sequence[str] = (), bucket_key: Column | None = None,
                buckets: int | None = None, count_col: str | None = None,
                bucket: Column | None = None) -> DataFrame:
    """1-based ``row_number`` along a total ``order`` computed two-phase; optionally
    the group size as ``count_col``."""
    d = df.withColumn("_one", F.lit(1).cast("long"))
    r = running_sums(d, order, ["_one"], partition_cols, bucket_key, buckets, bucket)
    r = r.withColumnRenamed("run__one", rank_col)
    if count_col:
        r = r.withColumnRenamed("tot__one", count_col)
    else:
        r = r.drop("tot__one")
    return r.drop("_one")
