"""Source and sink queries.

File-format round trips write a driver table with Spark into a fresh folder under the
shared checkpoint directory, read it back with the operator under test, and
aggregate, so the SQL oracle can compute the same figures from the table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.operators import relational as R
from kestrel.plans.catalog import register
from kestrel.plans.q_relational import META_PART, REVIEWS_LINEITEM
from kestrel.session import scratch_path
from kestrel.sources import csv_text, json_lines, report

EVENTS_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
                 "value double, props string")


def events_as_json(spark, sf_dir) -> str:
    path = scratch_path(spark, "events_json")
    json_lines.write_json_lines(T.load(spark, sf_dir, "events"), path)
    return path


@register("json_lines_scan", """
SELECT event_type, count(*) AS n_events, sum(value) AS total_value, max(ts) AS last_ts,
       min(ts) AS first_ts, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
FROM events GROUP BY event_type""")
def json_lines_scan(spark, sf_dir):
    """Events -> JSON lines -> read with an explicit schema -> aggregate."""
    ev = json_lines.read_json_lines(spark, events_as_json(spark, sf_dir), EVENTS_SCHEMA)
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"),
        F.max("ts").alias("last_ts"), F.min("ts").alias("first_ts"),
        F.sum(F.get_json_object("props", "$.k").cast("long")).alias("sum_k"))


@register("json_schema_infer", """
SELECT column_name,
       CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT') THEN 'bigint'
            WHEN column_type IN ('DOUBLE', 'FLOAT') THEN 'double'
            WHEN column_type = 'BOOLEAN' THEN 'boolean'
            ELSE 'string' END AS data_type
FROM (DESCRIBE events) d""")
def json_schema_infer(spark, sf_dir):
    """The schema inferred from the JSON lines, as (column_name, data_type) rows.

    JSON inference sees integers as bigint, decimals as double and every other scalar,
    timestamps included, as string; the SQL twin applies that rule to the table's
    own column types."""
    return json_lines.infer_json_schema(spark, events_as_json(spark, sf_dir))


def _mixed_json_lines(spark, sf_dir) -> str:
    """One line per event: 'error' events carry an illegal ``\\q`` escape in their
    note, 'view' events are cut short (broken JSON), all others are plain JSON."""
    ev = T.load(spark, sf_dir, "events")
    plain = F.to_json(F.struct("event_id", "user_id", "event_type",
                               F.concat(F.lit("n"), F.col("event_type")).alias("note")))
    escaped = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                       F.lit(',"user_id":'), F.col("user_id").cast("string"),
                       F.lit(',"event_type":"error","note":"a\\qb"}'))
    broken = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                      F.lit(',"event_type":"view"'))
    line = (F.when(F.col("event_type") == "error", escaped)
             .when(F.col("event_type") == "view", broken)
             .otherwise(plain))
    path = scratch_path(spark, "mixed_json")
    ev.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


@register("json_lenient_escape", """
SELECT count(*) FILTER (WHERE event_type <> 'view') AS n_good,
       count(*) FILTER (WHERE event_type = 'view') AS n_corrupt,
       count(*) FILTER (WHERE event_type = 'error') AS n_unescaped,
       count(*) FILTER (WHERE event_type NOT IN ('view', 'error')) AS n_plain_notes
FROM events""")
def json_lenient_escape(spark, sf_dir):
    """S3: ``\\q`` is read as ``q``; broken lines land in the corrupt side output."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("event_type", StringType()), StructField("note", StringType())])
    parsed = json_lines.read_json_lines_with_corrupt(
        spark, _mixed_json_lines(spark, sf_dir), schema)
    corrupt = F.col(json_lines.CORRUPT_COL).isNotNull()
    # One pass counts both sides; the corrupt side is the reader's side output.
    return parsed.agg(
        F.count(F.when(~corrupt, F.lit(1))).alias("n_good"),
        F.count(F.when(corrupt, F.lit(1))).alias("n_corrupt"),
        F.count(F.when(~corrupt & (F.col("note") == "aqb"), 1)).alias("n_unescaped"),
        F.count(F.when(~corrupt & (F.col("note") == F.concat(F.lit("n"), F.col("event_type"))), 1))
        .alias("n_plain_notes"))


@register("csv_header_scan", """
SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def csv_header_scan(spark, sf_dir):
    """Labelled text written as header CSV and read back: quotes and newlines kept."""
    path = scratch_path(spark, "movie_csv")
    src = T.labelled_text(spark, sf_dir).select("doc_id", "text", F.col("quality").alias("label"))
    csv_text.write_csv_header(src, path)
    return csv_text.read_csv_header(spark, path, "doc_id long, text string, label int")


@register("csv_typed_scan", """
SELECT CAST(l_quantity AS DOUBLE) AS min_temp, CAST(l_extendedprice AS DOUBLE) AS max_temp FROM lineitem""")
def csv_typed_scan(spark, sf_dir):
    """A two-column CSV read with every column forced to double."""
    path = scratch_path(spark, "weather_csv")
    li = T.load(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("min_temp"), F.col("l_extendedprice").alias("max_temp"))
    csv_text.write_csv_header(li, path)
    return csv_text.read_csv_doubles(spark, path, ["min_temp", "max_temp"])


def _report_sql() -> str:
    widths = report.REPORT_WIDTHS

    def pad(expr, w):
        return (f"lpad(coalesce({expr}, ''), "
                f"CAST(greatest(length(coalesce({expr}, '')), {w}) AS INTEGER), ' ')")

    fields = ["CAST(asin AS VARCHAR)", "CAST(num_reviews AS VARCHAR)",
              "strftime(review_day, '%m %-d, %Y')", "CAST(avg_rating AS VARCHAR)", "brand"]
    line = " || chr(9) || ".join(pad(f, w) for f, w in zip(fields, widths))
    header = report.header_line().replace("'", "''")
    return f"""
WITH top AS (
  SELECT g.asin, g.review_day, g.num_reviews, round(g.avg_rating, 4) AS avg_rating, m.brand
  FROM (SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
        FROM {REVIEWS_LINEITEM} r GROUP BY asin, review_day) g
  JOIN (SELECT asin, min(brand) AS brand FROM {META_PART} mm GROUP BY asin) m ON g.asin = m.asin
  ORDER BY g.num_reviews DESC, g.asin, g.review_day LIMIT 15)
SELECT 0 AS line_no, '{header}' AS line
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY num_reviews DESC, asin, review_day) AS INTEGER), {line} FROM top"""


@register("fixed_width_report", _report_sql())
def fixed_width_report(spark, sf_dir):
    """S7 + T9: the top-15 report as right-aligned, tab-joined lines."""
    top = R.top_products(T.reviews_from_lineitem(spark, sf_dir),
                         T.metadata_from_part(spark, sf_dir), k=15)
    return report.fixed_width_report(top, R.review_ranking_order())


@register("review_report_job", _report_sql())
def review_report_job(spark, sf_dir):
    """Q1 from files to report: reviews and metadata as JSON lines (S1), count and average
    per product and day (A1), brands of repeated metadata (J2), top 15 (F1), report (S7)."""
    reviews, meta = scratch_path(spark, "reviews_json"), scratch_path(spark, "metadata_json")
    source = T.reviews_from_lineitem(spark, sf_dir)
    json_lines.write_json_lines(source.select(
        "asin", F.date_format("review_day", report.REVIEW_TIME_FORMAT).alias("reviewTime"), "overall"), reviews)
    json_lines.write_json_lines(T.metadata_from_part(spark, sf_dir), meta)
    day = F.to_date("reviewTime", report.REVIEW_TIME_FORMAT).alias("review_day")
    top = R.top_products(
        json_lines.read_json_lines(spark, reviews, "asin long, reviewTime string, overall double")
                  .select("asin", day, "overall"),
        json_lines.read_json_lines(spark, meta, "asin long, brand string"), k=15)
    return report.fixed_width_report(top, R.review_ranking_order())


@register("pad_left", """
SELECT p_partkey,
       lpad(p_name, CAST(greatest(length(p_name), 20) AS INTEGER), ' ') AS name_20,
       lpad(p_brand, CAST(greatest(length(p_brand), 5) AS INTEGER), ' ') AS brand_5
FROM part""")
def pad_left(spark, sf_dir):
    """Right-align in a width without cutting longer values (brands exceed 5)."""
    part = T.load(spark, sf_dir, "part")
    return part.select("p_partkey", report.pad_left(F.col("p_name"), 20).alias("name_20"),
                       report.pad_left(F.col("p_brand"), 5).alias("brand_5"))
