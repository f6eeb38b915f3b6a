"""Rows and tables that the tests of the operators share."""

import pytest

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [  # nulls, empty, blank and very short texts, repeated rows, ties
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4),
    (4, "one", "en", "s", 3), (4, "one", "en", "s", 3), (5, "one", "de", None, 3),
    (None, "one two three", "en", "s", 13), (6, "one two three four five six", "en", "t", 27),
    (7, "one two three four five six", "en", "t", 27), (7, "other text", "en", "t", 10),
    (8, "né à l'été 日本 😀 " * 3, "fr", "é", 40), (9, "word " * 30_000, "en", "t", 150_000),
]


@pytest.fixture()
def edge_docs(spark):
    """Awkward rows, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    d = spark.createDataFrame(EDGE, COLUMNS)
    return d.withColumn("size", F.lit("x")).withColumn("digest", F.lit(1)) \
            .withColumn("_id", F.lit(None).cast("int")).withColumn("kept", F.lit(False)) \
            .withColumn("row", F.lit(2)).withColumn("comp", F.lit(3)).withColumn("_salt", F.lit("s"))


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
