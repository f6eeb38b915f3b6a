"""Helpers shared by the operators: checkpoints, hashes, two-phase running sums."""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir

HASH_BITS = 52  # digests are read as integers a double holds exactly


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of ``spark.checkpoint.dir``: a lost executor
    costs a read and not a recomputation. Spark removes the files once nothing refers to
    them (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(df: DataFrame, rows_per_partition: int = 100_000) -> DataFrame:
    """A checkpoint read in as few partitions as its rows need: small tables don't keep a task
    per partition of what they were made from."""
    ensure_checkpoint_dir(df.sparkSession)
    return _counted(df, None, rows_per_partition, lambda d: d.checkpoint(eager=True))[0]


def rewritten(df: DataFrame, folder: str, flag: str | None = None, rows_per_partition: int = 100_000
              ) -> tuple[DataFrame, int, int]:
    """A table that a loop carries from round to round: written as Parquet under ``folder`` and
    read again in as few partitions as its rows need; the number of rows; and of rows where
    ``flag`` holds. A checkpoint keeps Spark's size estimate of what it was made from and a
    join multiplies the estimates of its sides, so the digits of a carried table's estimate
    would multiply in every round until these numbers alone fill the driver. Files are
    estimated by their size. The caller removes ``folder``."""
    path = f"{folder}/{uuid.uuid4().hex}"

    def through_files(d: DataFrame) -> DataFrame:
        d.write.parquet(path)
        return d.sparkSession.read.schema(df.schema).parquet(path)

    return _counted(df, flag, rows_per_partition, through_files)


def _counted(df: DataFrame, flag: str | None, rows_per_partition: int,
             stored: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int, int]:
    """Rows are observed as the table is stored, so the loops over small tables spend one job
    where count and test would take two more. A stage that is run again after a lost executor
    may count twice: zero stays zero, more stays more. What the table was made from is let go
    of at once (``release``): with many partitions the driver's heap otherwise grows by what a
    task leaves behind, several times what is alive."""
    seen = Observation()
    marked = F.count_if(F.col(flag)) if flag else F.count(F.lit(1))
    with single_partitions_stay(df.sparkSession):
        out = stored(df.observe(seen, F.count(F.lit(1)).alias("n"), marked.alias("m")))
    n = seen.get["n"]
    release(out)
    return out.coalesce(max(1, -(-n // rows_per_partition))), n, seen.get["m"]


@contextmanager
def single_partitions_stay(spark: SparkSession) -> Iterator[None]:
    """Plan joins of two single partitions in one task. Spark shuffles them if it estimates
    either at more than this setting, and a join is estimated at the product of its sides.
    ``compact`` and ``rewritten`` give one partition only to tables they have counted."""
    name = "spark.sql.maxSinglePartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str((1 << 63) - 1))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def release(df: DataFrame) -> None:
    """Let go of what earlier rounds of a loop left behind. Spark removes shuffles, checkpoints
    and compiled plans once the driver's collector has seen that nothing refers to them; a
    long loop of small jobs gives it no reason to run (``spark.cleaner.periodicGC.interval``
    is half an hour)."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def text_or_empty(col: str | Column = "text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def key_text(col: str | Column) -> Column:
    """The key as text; null becomes ``null``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("null"))


def digest52(key: Column) -> Column:
    """The first 52 bits of the MD5 of a string, as a non-negative long."""
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def bucket_count(rows: int, groups: int = 1) -> int:
    """Buckets per group: about the square root of the rows, so that neither a bucket's
    window nor the window over a group's bucket totals outgrows a task."""
    return max(1, math.isqrt(max(0, rows) // max(1, groups)) // 4)


def running_sum(df: DataFrame, group: str, digest: str, order: list[str], value: str,
                out: str, buckets: int, totals_of: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``group`` that come
    before the row in the order (``digest``, *``order``).

    ``group`` and ``digest`` are non-null integers, ``digest`` uniform below 2^52. Rows
    are dealt by (group, range of the digest), so a group that holds a third of all rows
    is spread over ``buckets`` windows; only the totals of the buckets meet per group.
    The result doesn't depend on ``buckets``. The totals are taken from ``totals_of``: the
    same rows without wide columns (default: ``df``, which should then be a checkpoint).
    """
    width = (1 << HASH_BITS) // buckets + 1
    bucket = F.floor(F.col(digest) / F.lit(float(width))).cast("int")
    d = df.withColumn("_bucket", bucket)
    narrow = d if totals_of is None else totals_of.withColumn("_bucket", bucket)
    inner = Window.partitionBy(group, "_bucket").orderBy(digest, *order) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(group).orderBy("_bucket") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    totals = narrow.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum")) \
              .select(group, "_bucket",
                      F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return d.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0))) \
            .join(totals, [group, "_bucket"]) \
            .withColumn(out, F.col("_in") + F.col("_before")) \
            .drop("_in", "_before", "_bucket")


def text_digest(col: str | Column = "text") -> Column:
    """16 bytes of the SHA-256 of a text (null: of the empty one)."""
    return F.unhex(F.substring(F.sha2(text_or_empty(col), 256), 1, 32))


def merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A sort-merge join whatever the sizes: in loops of many small joins nothing is
    gathered on the driver for a broadcast, and adaptive execution still splits hot keys."""
    return left.join(right.hint("merge"), on, how)


def salted_join(rows: DataFrame, groups: DataFrame, keys: list[str], unique: str,
                salts: int = 16) -> DataFrame:
    """Inner join of rows with one row per key of ``groups``. Every key is copied ``salts``
    times and a row takes the copy that its ``unique`` column hashes to, so a key with a
    third of all rows is spread over tasks."""
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(unique), F.lit(salts)).cast("int")) \
               .join(copies, [*keys, "_salt"]).drop("_salt")


def drop_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, digest, kept) keeps; of rows that
    repeat with the same id and text, as one is kept, one stays."""
    verdict = decisions.groupBy("doc_id", "digest") \
                       .agg(F.count_if("kept").alias("_kept"), F.count(F.lit(1)).alias("_all"))
    verdict = checkpointed(verdict.where("_kept < _all")
                           .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "_kept"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").alias("_i"), text_digest("text").alias("_t"))
    same = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_digest"))
    stay = packed.join(verdict, same, "left_anti")
    repeats = verdict.where("_kept > 0")
    if not repeats.isEmpty():
        stay = stay.unionByName(packed.join(repeats, same, "left_semi").dropDuplicates(["_i", "_t"]))
    return stay.select("row.*")
