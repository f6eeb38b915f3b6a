"""CSV scans (S4, S5): header row, long quoted multi-line text, forced double columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StructField, StructType


def read_csv_header(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV whose quoted fields may hold newlines and doubled quotes."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path))


def write_csv_header(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite")
       .option("header", True).option("quote", '"').option("escape", '"')
       .option("quoteAll", True)
       .csv(path))


def read_csv_doubles(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every column read as double (S5); a non-numeric value fails the read."""
    schema = StructType([StructField(c, DoubleType(), True) for c in columns])
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))
