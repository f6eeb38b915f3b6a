"""Loading the driver's parquet tables and mapping them onto the reference's inputs.

The reference reads product reviews, product metadata and labelled text; the test
tables stand in for them (see FIXTURES.md section 2). Each view below is a plain
projection, so Catalyst prunes the parquet scan to the named columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import SCAN_PARTITIONS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str | Column) -> DataFrame:
    """Hash-partition on a unique key where the session asks for it.

    A machine whose inputs are single parquet files has one scan task; setting
    ``spark.kestrel.scanPartitions`` there lets the row work use every core. Unset, as on
    a cluster with many splits, the plan has no such shuffle, whatever the input's size.
    """
    wanted = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(wanted), key) if wanted else df


def lineitem_row_key() -> Column:
    """Unique row key of lineitem: only the four columns together are unique."""
    return F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, spread if the session asks for it."""
    return spread(load(spark, sf_dir, "documents"), "doc_id")


def reviews_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviews(asin, review_day, overall) with one review per line item."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asin"),
        F.to_date("l_shipdate").alias("review_day"),
        F.col("l_quantity").alias("overall"),
    )


def reviews_from_events(spark: SparkSession, sf_dir: str, null_type: str | None = None
                        ) -> DataFrame:
    """reviews(asin, review_day, overall) from events: denser (user, day) groups.

    With ``null_type`` the rating of that event type is blanked, giving null ratings.
    """
    rating = F.col("value")
    if null_type is not None:
        rating = F.when(F.col("event_type") == null_type, F.lit(None).cast("double")) \
                  .otherwise(F.col("value"))
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("asin"),
        F.to_date("ts").alias("review_day"),
        rating.alias("overall"),
    )


def metadata_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metadata(asin, brand) with unique keys."""
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asin"), F.col("p_brand").alias("brand"))


def metadata_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metadata(asin, brand) where a key repeats with different brands."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asin"), F.col("l_returnflag").alias("brand"))


def labelled_text(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """movie.csv stand-in: documents joined to labels; ``label`` = quality."""
    docs = documents(spark, sf_dir)
    labels = load(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", how)
