"""Relational queries: P, J, A, W, F keys and the flagship review ranking (Q1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.operators import relational as R
from kestrel.plans.catalog import register

# SQL fragments for the stand-in views of the reference's inputs.
REVIEWS_LINEITEM = """(SELECT l_partkey AS asin, CAST(l_shipdate AS DATE) AS review_day,
        l_quantity AS overall FROM lineitem)"""
REVIEWS_EVENTS = """(SELECT user_id AS asin, CAST(ts AS DATE) AS review_day,
        value AS overall FROM events)"""
REVIEWS_EVENTS_NULLS = """(SELECT user_id AS asin, CAST(ts AS DATE) AS review_day,
        CASE WHEN event_type = 'error' THEN NULL ELSE value END AS overall FROM events)"""


def _top_products_sql(reviews: str, k: int, meta: str) -> str:
    return f"""
SELECT g.asin, g.review_day, g.num_reviews, round(g.avg_rating, 4) AS avg_rating, m.brand
FROM (SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
      FROM {reviews} r GROUP BY asin, review_day) g
JOIN (SELECT asin, min(brand) AS brand FROM {meta} mm GROUP BY asin) m ON g.asin = m.asin
ORDER BY g.num_reviews DESC, g.asin, g.review_day
LIMIT {k}"""


META_PART = "(SELECT p_partkey AS asin, p_brand AS brand FROM part)"
META_LINEITEM = "(SELECT l_partkey AS asin, l_returnflag AS brand FROM lineitem)"


@register("top_products", _top_products_sql(REVIEWS_LINEITEM, 15, META_PART))
def top_products(spark, sf_dir):
    """Q1: reviews -> count/avg per (product, day) -> brand -> busiest 15."""
    return R.top_products(T.reviews_from_lineitem(spark, sf_dir),
                          T.metadata_from_part(spark, sf_dir), k=15)


@register("top_products_events", _top_products_sql(REVIEWS_EVENTS, 15, META_PART))
def top_products_events(spark, sf_dir):
    """Q1 over the denser (user, day) groups of ``events``."""
    return R.top_products(T.reviews_from_events(spark, sf_dir),
                          T.metadata_from_part(spark, sf_dir), k=15)


@register("project_columns", "SELECT p_partkey AS asin, p_brand AS brand FROM part")
def project_columns(spark, sf_dir):
    part = T.load(spark, sf_dir, "part")
    return R.project_columns(part.withColumnRenamed("p_partkey", "asin")
                                 .withColumnRenamed("p_brand", "brand"), ["asin", "brand"])


@register("alias_aggregates", f"""
SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
FROM {REVIEWS_EVENTS} r GROUP BY asin, review_day""")
def alias_aggregates(spark, sf_dir):
    return R.group_count_avg(T.reviews_from_events(spark, sf_dir))


@register("group_count_avg", f"""
SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
FROM {REVIEWS_LINEITEM} r GROUP BY asin, review_day""")
def group_count_avg(spark, sf_dir):
    """A1 on lineitem: one row per (part, ship day)."""
    return R.group_count_avg(T.reviews_from_lineitem(spark, sf_dir))


@register("count_non_null", f"""
SELECT asin, review_day, count(*) AS n_rows, count(overall) AS n_non_null
FROM {REVIEWS_EVENTS_NULLS} r GROUP BY asin, review_day""")
def count_non_null(spark, sf_dir):
    """A2: error events carry no rating; count() skips them, count(*) does not."""
    return R.count_non_null(T.reviews_from_events(spark, sf_dir, null_type="error"),
                            ["asin", "review_day"], "overall")


@register("drop_column", """
SELECT d.doc_id, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def drop_column(spark, sf_dir):
    df = T.labelled_text(spark, sf_dir).select("doc_id", "text", F.col("quality").alias("label"))
    return R.drop_column(df, "label")


@register("cast_label", """
SELECT doc_id, CAST(quality AS FLOAT) AS label FROM labels""")
def cast_label(spark, sf_dir):
    df = T.load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return R.cast_label(df, "label", "float")


_TABULAR_SQL = """(SELECT d.doc_id, d.n_chars,
        len(list_filter(string_split_regex(regexp_replace(lower(d.text), '[^a-z ]', '', 'g'), ' +'), lambda x: x <> '')) AS n_tokens,
        len(list_distinct(list_filter(string_split_regex(regexp_replace(lower(d.text), '[^a-z ]', '', 'g'), ' +'), lambda x: x <> ''))) AS n_distinct_tokens,
        l.quality
     FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@register("positional_features", f"""
SELECT doc_id, [CAST(n_chars AS DOUBLE), CAST(n_tokens AS DOUBLE), CAST(n_distinct_tokens AS DOUBLE)] AS features,
       quality AS label
FROM {_TABULAR_SQL} t""")
def positional_features(spark, sf_dir):
    """P5 over the tabular classification table: all but the last column are features."""
    from kestrel.plans.q_models import tabular_table
    return R.positional_features(tabular_table(spark, sf_dir), keep=["doc_id"])


@register("round_metric", """
SELECT l_returnflag, l_linestatus,
       round(avg(l_quantity), 4) AS avg_qty_4,
       round(avg(l_discount), 3) * 100 AS avg_disc_pct
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def round_metric(spark, sf_dir):
    li = T.load(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"))
    return g.select("l_returnflag", "l_linestatus",
                    R.round_half_up("q", 4).alias("avg_qty_4"),
                    R.round_percent("d", 3).alias("avg_disc_pct"))


@register("inner_equi_join", f"""
SELECT g.asin, g.review_day, g.num_reviews, g.avg_rating, m.brand
FROM (SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
      FROM {REVIEWS_LINEITEM} r GROUP BY asin, review_day) g
JOIN {META_PART} m ON g.asin = m.asin""")
def inner_equi_join(spark, sf_dir):
    grouped = R.group_count_avg(T.reviews_from_lineitem(spark, sf_dir))
    return R.inner_equi_join(grouped, T.metadata_from_part(spark, sf_dir), "asin")


@register("join_fanout_dedupe", f"""
SELECT g.asin, g.review_day, g.num_reviews, g.avg_rating, m.brand
FROM (SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
      FROM {REVIEWS_LINEITEM} r GROUP BY asin, review_day) g
JOIN (SELECT asin, min(brand) AS brand FROM {META_LINEITEM} mm GROUP BY asin) m
  ON g.asin = m.asin""")
def join_fanout_dedupe(spark, sf_dir):
    """Metadata keys repeat (a part has several return flags)."""
    grouped = R.group_count_avg(T.reviews_from_lineitem(spark, sf_dir))
    return R.join_fanout_dedupe(grouped, T.metadata_from_lineitem(spark, sf_dir))


@register("distinct_rows", """
SELECT DISTINCT d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def distinct_rows(spark, sf_dir):
    df = T.labelled_text(spark, sf_dir).select("text", F.col("quality").alias("label"))
    return R.distinct_rows(df)


@register("distinct_on_subset", """
SELECT asin, review_day, l_orderkey, l_quantity, l_returnflag FROM (
  SELECT l_partkey AS asin, CAST(l_shipdate AS DATE) AS review_day, l_orderkey, l_quantity,
         l_returnflag,
         row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey, l_suppkey, l_linenumber) AS rn
  FROM lineitem) t WHERE rn = 1""")
def distinct_on_subset(spark, sf_dir):
    """A4: one line item per (part, day), the first by (order, supplier, line number)."""
    li = T.load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("asin"), F.to_date("l_shipdate").alias("review_day"),
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    return R.distinct_on_subset(li, ["asin", "review_day"],
                                ["l_orderkey", "l_suppkey", "l_linenumber"],
                                ["l_orderkey", "l_quantity", "l_returnflag"])


@register("row_count", """
SELECT count(*) AS n_rows, 7 AS n_cols FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def row_count(spark, sf_dir):
    return R.row_count(T.labelled_text(spark, sf_dir))


_LEFT_LABELLED = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@register("null_counts", f"""
SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id,
       count(*) FILTER (WHERE text IS NULL) AS text,
       count(*) FILTER (WHERE lang IS NULL) AS lang,
       count(*) FILTER (WHERE source IS NULL) AS source,
       count(*) FILTER (WHERE n_chars IS NULL) AS n_chars,
       count(*) FILTER (WHERE quality IS NULL) AS quality,
       count(*) FILTER (WHERE toxic IS NULL) AS toxic
FROM {_LEFT_LABELLED} t""")
def null_counts(spark, sf_dir):
    """A6 over documents left-joined to labels: unlabelled documents give nulls."""
    return R.null_counts(T.labelled_text(spark, sf_dir, "left"))


@register("null_total", f"""
SELECT CAST(sum((doc_id IS NULL)::INT + (text IS NULL)::INT + (lang IS NULL)::INT
       + (source IS NULL)::INT + (n_chars IS NULL)::INT + (toxic IS NULL)::INT) AS BIGINT) AS n_null
FROM {_LEFT_LABELLED} t""")
def null_total(spark, sf_dir):
    """Null cells over all columns but the label."""
    return R.null_total(T.labelled_text(spark, sf_dir, "left"), exclude=["quality"])


@register("duplicates_removed", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)) AS n_distinct,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT d.text, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)) AS BIGINT) AS n_removed
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def duplicates_removed(spark, sf_dir):
    df = T.labelled_text(spark, sf_dir).select("text", "quality")
    return R.duplicates_removed(df)


_DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("describe_numeric", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, "
    f"stddev_samp({c}) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
    for c in _DESCRIBE_COLS))
def describe_numeric(spark, sf_dir):
    return R.describe_numeric(T.load(spark, sf_dir, "lineitem"), list(_DESCRIBE_COLS))


@register("top_products_per_day", f"""
SELECT asin, review_day, num_reviews, avg_rating, rank FROM (
  SELECT asin, review_day, num_reviews, round(avg_rating, 4) AS avg_rating,
         row_number() OVER (PARTITION BY review_day ORDER BY num_reviews DESC, asin) AS rank
  FROM (SELECT asin, review_day, count(overall) AS num_reviews, avg(overall) AS avg_rating
        FROM {REVIEWS_EVENTS} r GROUP BY asin, review_day) g) t
WHERE rank <= 15""")
def top_products_per_day(spark, sf_dir):
    """The task text's "top 15 each day", over (user, day) groups of events."""
    g = R.group_count_avg(T.reviews_from_events(spark, sf_dir))
    g = g.withColumn("avg_rating", R.round_half_up("avg_rating", 4))
    return R.top_k_per_group(g, 15, ["review_day"], [F.desc("num_reviews"), F.asc("asin")])


@register("top_k_global", f"""
SELECT g.asin, g.review_day, g.num_reviews, g.avg_rating
FROM (SELECT asin, review_day, count(overall) AS num_reviews, round(avg(overall), 4) AS avg_rating
      FROM {REVIEWS_EVENTS} r GROUP BY asin, review_day) g
ORDER BY g.num_reviews DESC, g.asin, g.review_day LIMIT 15""")
def top_k_global(spark, sf_dir):
    g = R.group_count_avg(T.reviews_from_events(spark, sf_dir))
    g = g.withColumn("avg_rating", R.round_half_up("avg_rating", 4))
    return R.top_k_global(g, 15, R.review_ranking_order())


@register("head_rows", """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 5""")
def head_rows(spark, sf_dir):
    return R.head_rows(T.load(spark, sf_dir, "orders"), 5, ["o_orderkey"])


@register("null_flag", f"""
SELECT doc_id, CASE WHEN quality IS NULL THEN 'quality' END AS quality_null,
       CASE WHEN toxic IS NULL THEN 'toxic' END AS toxic_null
FROM {_LEFT_LABELLED} t""")
def null_flag(spark, sf_dir):
    """The column name where a value is null, one row per document."""
    return R.null_flag(T.labelled_text(spark, sf_dir, "left"), ["quality", "toxic"],
                       keep=["doc_id"])
