"""Projections, joins, aggregations, de-duplication, windows and top-k.

All functions are lazy DataFrame -> DataFrame transformations. Ordering rules always end
in unique tie-breakers so results do not depend on partitioning or task timing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


# --- P: projections ---------------------------------------------------------------

def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the named columns (P1). Catalyst pushes the projection into the scan."""
    return df.select(*columns)


def drop_column(df: DataFrame, column: str) -> DataFrame:
    """Remove one column, e.g. the label before building features."""
    return df.drop(column)


def cast_label(df: DataFrame, column: str = "label", to: str = "float") -> DataFrame:
    """Cast the label column (P4). ``try_cast`` gives null instead of raising under ANSI."""
    return df.withColumn(column, F.expr(f"try_cast(`{column}` AS {to})"))


def positional_features(df: DataFrame, features_col: str = "features",
                        label_col: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """All columns but the last become a feature array, the last one the label (P5).

    ``keep`` names leading key columns that are neither features nor label.
    """
    cols = [c for c in df.columns if c not in keep]
    feats, label = cols[:-1], cols[-1]
    return df.select(
        *keep,
        F.array(*[F.col(c).cast("double") for c in feats]).alias(features_col),
        F.col(label).alias(label_col),
    )


def round_half_up(col: str | Column, digits: int) -> Column:
    """Round to ``digits`` decimals (P7), half away from zero."""
    return F.round(col if isinstance(col, Column) else F.col(col), digits)


def round_percent(col: str | Column, digits: int = 3) -> Column:
    """``round(x, 3) * 100`` as in the metric tables."""
    return round_half_up(col, digits) * F.lit(100.0)


# --- A: aggregations --------------------------------------------------------------

def group_count_avg(reviews: DataFrame, keys: Sequence[str] = ("asin", "review_day"),
                    rating: str = "overall") -> DataFrame:
    """Number of non-null ratings and their mean per group.

    Planned as partial + final hash aggregation, so a hot key is combined map-side
    before the shuffle.
    """
    return reviews.groupBy(*keys).agg(
        F.count(rating).alias("num_reviews"),
        F.avg(rating).alias("avg_rating"),
    )


def count_non_null(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows per group beside the count of non-null values of ``column`` (A2)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(column).alias("n_non_null"),
    )


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop full-row duplicates over ``columns`` (A3)."""
    cols = list(columns) if columns else df.columns
    return df.select(*cols).distinct()


def distinct_on_subset(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       payload: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``order`` tuple (A4).

    ``min(struct(order..., payload...))`` is an ordinary partial aggregate, so unlike a
    row_number window it never sorts or gathers a whole group in one task.
    """
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + \
             [F.col(c) for c in payload]
    return (df.groupBy(*keys)
              .agg(F.min(F.struct(*fields)).alias("_first"))
              .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload]))


def row_count(df: DataFrame) -> DataFrame:
    """Row and column counts, like ``df.shape`` (A5)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")) \
             .withColumn("n_cols", F.lit(len(df.columns)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column in one pass, one row with a column per input column."""
    cols = list(columns) if columns else df.columns
    return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])


def null_flag(df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = (),
              suffix: str = "_null") -> DataFrame:
    """Per row and column, the column's name where the value is null, else null (P6);
    ``keep`` columns are passed through."""
    cols = list(columns) if columns else [c for c in df.columns if c not in keep]
    return df.select(*keep, *[F.when(F.col(c).isNull(), F.lit(c)).alias(f"{c}{suffix}")
                              for c in cols])


def null_total(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Sum of the per-column null counts, leaving out ``exclude``."""
    cols = [c for c in df.columns if c not in exclude]
    total = sum((F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols),
                F.lit(0))
    return df.agg(F.sum(total).cast("long").alias("n_null"))


def duplicates_removed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows minus distinct rows (A8); one aggregation over the distinct rows' digests, so
    that only 64 characters of a row are shuffled."""
    cols = list(columns) if columns else df.columns
    row = F.sha2(F.to_json(F.struct(*cols)), 256)
    per_row = df.groupBy(row.alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(
        F.sum("_n").cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        (F.sum("_n") - F.count(F.lit(1))).cast("long").alias("n_removed"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min, max per column in long form.

    One global aggregation (partial per task, one final row), then ``stack`` turns the
    single wide row into one row per column; no data shuffle.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', n{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(columns))
    return wide.selectExpr(
        f"stack({len(columns)}, {parts}) AS (column_name, count, mean, stddev, min, max)")


# --- J: joins ---------------------------------------------------------------------

def dedupe_metadata(meta: DataFrame, key: str = "asin", value: str = "brand") -> DataFrame:
    """One metadata row per key; the survivor is the smallest non-null value.

    Deduplicating before the join removes the fan-out the reference repairs afterwards.
    """
    return meta.groupBy(key).agg(F.min(value).alias(value))


def inner_equi_join(left: DataFrame, right: DataFrame, key: str = "asin") -> DataFrame:
    """Inner equi-join (J1); null keys and unmatched rows drop out.

    No hint: AQE turns it into a broadcast join at run time only when the measured
    size of one side is under the broadcast threshold, else a sort-merge join whose
    skewed partitions AQE splits.
    """
    return left.join(right, key, "inner")


def join_fanout_dedupe(grouped: DataFrame, meta: DataFrame, key: str = "asin",
                       value: str = "brand") -> DataFrame:
    """Attach metadata with repeated keys, one output row per left row."""
    return inner_equi_join(grouped, dedupe_metadata(meta, key, value), key)


# --- W, F: ranking ----------------------------------------------------------------

def top_k_global(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Global top k (F1): ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject,
    each task keeps k rows and one task merges them."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, k: int, group: Sequence[str], order: Sequence[Column],
                    rank_col: str = "rank") -> DataFrame:
    """Top k rows per group.

    ``row_number() <= k`` is planned with WindowGroupLimit, which drops all but k rows
    per group inside each task before the shuffle, so a hot group costs k rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")) \
             .where(F.col(rank_col) <= k)


def head_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First n rows in an explicit order (F2); Spark rows have no implicit order."""
    return df.orderBy(*_cols(order)).limit(n)


# --- the review ranking job -------------------------------------------------------

def review_ranking_order() -> list[Column]:
    """Busiest groups first; ties broken by product id, then day."""
    return [F.desc("num_reviews"), F.asc("asin"), F.asc("review_day")]


def top_products(reviews: DataFrame, meta: DataFrame, k: int = 15) -> DataFrame:
    """Count and average per (product, day), attach the brand, keep the k busiest (Q1).

    Same rows as ``top_k(join_fanout_dedupe(...))`` but planned for scale: a semi-join
    drops groups whose product has no metadata (no fan-out, no brand carried), the top k
    is taken, and only then are the metadata rows of the k winners joined (the winners,
    at most k rows, are broadcast) and reduced to the smallest brand. The sort-based
    ``min`` over string brands never runs on the whole metadata table.
    """
    grouped = group_count_avg(reviews)
    known = grouped.join(meta.select("asin"), "asin", "left_semi")
    top = top_k_global(known, k, review_ranking_order())
    keys = ["asin", "review_day", "num_reviews", "avg_rating"]
    with_brand = meta.join(F.broadcast(top), "asin").groupBy(*keys).agg(
        F.min("brand").alias("brand"))
    return with_brand.select("asin", "review_day", "num_reviews",
                             round_half_up("avg_rating", 4).alias("avg_rating"), "brand")
