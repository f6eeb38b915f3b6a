"""JSON-lines scans (S1-S3): explicit schema, schema inference, lenient escapes and a
side output for corrupt lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT_COL = "_corrupt_record"
# Six fraction digits keep the microseconds of timestamps on a write/read round trip.
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str,
                    lenient_escapes: bool = True) -> DataFrame:
    """Read one JSON object per line with a given schema.

    A given schema avoids the extra full pass of inference and lets the parser skip
    fields that are not requested. ``allowBackslashEscapingAnyCharacter`` accepts
    ``\\q`` as ``q`` (S3).
    """
    return (spark.read.schema(schema)
            .option("allowBackslashEscapingAnyCharacter", lenient_escapes)
            .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
            .option("mode", "PERMISSIVE")
            .json(path))


def read_json_lines_with_corrupt(spark: SparkSession, path: str, schema: StructType,
                                 lenient_escapes: bool = True) -> DataFrame:
    """Parsed rows plus ``_corrupt_record``, the raw text of a line that did not parse.

    The lines are read as text and parsed with ``from_json`` (same parser and options),
    so the raw line is an ordinary column: the corrupt side can be counted or written
    on its own, which Spark forbids for a raw JSON scan.
    """
    full = StructType(list(schema.fields)).add(CORRUPT_COL, "string")
    opts = {"allowBackslashEscapingAnyCharacter": str(bool(lenient_escapes)).lower(),
            "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT, "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT_COL}
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parsed = lines.select(F.from_json("value", full, opts).alias("_r"), "value")
    return parsed.select(
        *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields],
        F.when(F.col("_r").isNull() | F.col(f"_r.{CORRUPT_COL}").isNotNull(), F.col("value"))
         .alias(CORRUPT_COL))


def read_json_lines_checked(spark: SparkSession, path: str, schema: StructType,
                            lenient_escapes: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt lines) (S3): broken lines go to a side DataFrame
    ``(_corrupt_record)`` holding the raw line."""
    parsed = read_json_lines_with_corrupt(spark, path, schema, lenient_escapes)
    good = parsed.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    bad = parsed.where(F.col(CORRUPT_COL).isNotNull()).select(CORRUPT_COL)
    return good, bad


def infer_json_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0
                      ) -> DataFrame:
    """Infer the schema from the data (S2); returned as rows ``(column_name, data_type)``."""
    df = (spark.read.option("samplingRatio", sampling_ratio)
          .option("allowBackslashEscapingAnyCharacter", True)
          .json(path))
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def write_json_lines(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite")
       .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
       .json(path))
