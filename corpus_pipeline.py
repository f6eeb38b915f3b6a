"""From raw documents to token ids, in stages that are each written and read again.

Quality classifier, exact dedup, near dedup, source mixing, SentencePiece encoding: every
stage works on all rows that the one before kept. All but the last return the columns of
``documents``; the last returns the piece ids by doc_id. A document that the mix
takes twice is encoded twice, as two training rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import exact_dedup, mixing, near_dedup, quality, unigram
from kestrel.llm.common import table
from kestrel.llm.queries import PIECES
from kestrel.session import scratch_path

#: The classifier and the order of the mix aren't expressible in SQL.
ORACLE_SQL = None


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Its labelled rows come from ``documents``.

    Null, empty and wordless texts score the labelled mean and stay or go with it; long
    texts are read whole; repeated rows and texts with equal terms share a score and a fate;
    an empty table stays empty, and further columns are kept whatever their names."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of equal texts: the one with the largest doc_id.

    Null and empty texts are equal to one another; a null doc_id is the smallest; of rows
    that repeat with one id and text a single one stays; texts of any length are compared
    whole; an empty table stays empty, and further columns are kept whatever their names."""
    return exact_dedup.drop_equal_texts(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each near-duplicate class: the one with the least doc_id.

    Null, empty and wordless texts are linked only to equal ones; a null doc_id is the
    largest; of repeated rows one stays; long texts are shingled whole; an empty table stays
    empty, and further columns are kept whatever their names."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    Null and wordless texts have no words to take and go; a null source is a source of its
    own; equal positions go by doc_id; repeated rows are taken each for itself; an empty
    table stays empty, and further columns are kept whatever their names."""
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every training row.

    Null and empty texts have none; of segmentations that score alike the one whose last
    piece is longest wins; long texts are encoded whole; repeated rows repeat; an empty table
    gives no rows, and further columns are left out."""
    return unigram.encode_documents(docs, PIECES)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written as Parquet in the shared folder
    and read again."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "corpus-pipeline")  # removed when the driver ends
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
