"""Fixed-width text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the report layout: header texts and right-aligned field widths.
REPORT_HEADERS = ("<product ID>", "<num of reviews>", "<review time>", "<avg ratings>",
                  "<product brand name>")
REPORT_WIDTHS = (15, 20, 15, 20, 20)
# Day format of the review time field, e.g. "08 7, 2017".
REVIEW_TIME_FORMAT = "MM d, yyyy"


def pad_left(value: Column, width: int) -> Column:
    """Right-align in ``width`` characters without ever cutting a longer value.

    ``lpad`` alone truncates values longer than the width; ``str.rjust`` does not.
    A null prints as an empty padded field.
    """
    s = F.coalesce(value.cast("string"), F.lit(""))
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), " ")


def report_line(fields: Sequence[Column], widths: Sequence[int] = REPORT_WIDTHS) -> Column:
    return F.concat_ws("\t", *[pad_left(f, w) for f, w in zip(fields, widths)])


def header_line(headers: Sequence[str] = REPORT_HEADERS,
                widths: Sequence[int] = REPORT_WIDTHS) -> str:
    return "\t".join(h.rjust(w) for h, w in zip(headers, widths))


def fixed_width_report(top: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Report lines ``(line_no, line)`` for ranked rows; line 0 is the header.

    ``top`` holds ``asin, num_reviews, review_day, avg_rating, brand`` and is already cut
    to k rows, so numbering it with a global window touches k rows only.
    """
    from pyspark.sql import Window

    body = top.select(
        F.row_number().over(Window.orderBy(*order)).alias("line_no"),
        report_line([F.col("asin"), F.col("num_reviews"),
                     F.date_format("review_day", REVIEW_TIME_FORMAT),
                     F.col("avg_rating"), F.col("brand")]).alias("line"),
    )
    head = top.sparkSession.range(1).select(F.lit(0).alias("line_no"),
                                            F.lit(header_line()).alias("line"))
    return head.unionByName(body.withColumn("line_no", F.col("line_no").cast("int")))


def write_report(report: DataFrame, path: str) -> None:
    """Write the (small, k+1 line) report as one text file in line order."""
    (report.orderBy("line_no").coalesce(1).select("line")
           .write.mode("overwrite").text(path))
