"""Hand-made rows for the traps listed in FIXTURES.md section 3."""

import os

from pyspark.sql import functions as F

from kestrel.functions import text as X
from kestrel.operators import evaluation as E
from kestrel.operators import relational as R
from kestrel.sources import json_lines, report


def test_null_rating_is_not_counted(spark):
    df = spark.createDataFrame([("A", "d1", None), ("A", "d1", 4.0)],
                               "asin string, review_day string, overall double")
    row = R.group_count_avg(df).collect()[0]
    assert row["num_reviews"] == 1 and row["avg_rating"] == 4.0


def test_repeated_metadata_key_gives_one_row(spark):
    reviews = spark.createDataFrame([("A", "d1", 3.0)], "asin string, review_day string, overall double")
    meta = spark.createDataFrame([("A", "x"), ("A", "b")], "asin string, brand string")
    rows = R.join_fanout_dedupe(R.group_count_avg(reviews), meta).collect()
    assert len(rows) == 1 and rows[0]["brand"] == "b"


def test_product_without_metadata_is_absent(spark):
    reviews = spark.createDataFrame([("Z", "d1", 5.0), ("A", "d1", 1.0)],
                                    "asin string, review_day string, overall double")
    meta = spark.createDataFrame([("A", "b")], "asin string, brand string")
    rows = R.join_fanout_dedupe(R.group_count_avg(reviews), meta).collect()
    assert [r["asin"] for r in rows] == ["A"]


def test_tie_at_rank_k_smallest_asin_wins(spark):
    reviews = spark.createDataFrame(
        [("C", "2020-01-01", 1.0), ("A", "2020-01-01", 1.0), ("B", "2020-01-01", 1.0)],
        "asin string, review_day string, overall double")
    meta = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "asin string, brand string")
    rows = R.top_products(reviews.withColumn("review_day", F.to_date("review_day")), meta, k=2).collect()
    assert sorted(r["asin"] for r in rows) == ["A", "B"]


def _write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_illegal_escape_and_broken_line(spark, tmp_dir):
    from pyspark.sql.types import StringType, StructField, StructType
    path = os.path.join(tmp_dir, "lines")
    _write_lines(path, ['{"asin":"A","t":"a\\qb"}', "not json"])
    schema = StructType([StructField("asin", StringType()), StructField("t", StringType())])
    good, bad = json_lines.read_json_lines_checked(spark, path, schema)
    g = good.collect()
    assert [(r["asin"], r["t"]) for r in g] == [("A", "aqb")]
    assert [r[json_lines.CORRUPT_COL] for r in bad.collect()] == ["not json"]
    strict_good, strict_bad = json_lines.read_json_lines_checked(spark, path, schema,
                                                                 lenient_escapes=False)
    assert strict_good.count() == 0 and strict_bad.count() == 2


def test_newline_joins_neighbours(spark):
    df = spark.createDataFrame([(1, "good\nfilm")], "doc_id long, text string")
    toks = df.select(X.letter_tokens("text").alias("t")).collect()[0]["t"]
    assert toks == ["goodfilm"]


def test_value_wider_than_field_is_not_cut(spark):
    df = spark.createDataFrame([("x" * 21,), ("ab",)], "v string")
    out = [r[0] for r in df.select(report.pad_left(F.col("v"), 20)).collect()]
    assert out == ["x" * 21, " " * 18 + "ab"]


def test_stop_words_see_stems(spark):
    df = spark.createDataFrame([(1, "this was the film")], "doc_id long, text string")
    rows = X.clean_text(df).collect()
    # "this" -> "thi", "was" -> "wa": stems, not stop words; "the" is removed.
    assert rows[0]["clean_tokens"] == ["thi", "wa", "film"]
    rows_v = X.clean_text(df, strategy="vocabulary").collect()
    assert rows_v[0]["clean_tokens"] == rows[0]["clean_tokens"]


def test_no_positive_predicted_gives_null_precision(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = E.classification_metrics(df).collect()[0]
    assert row["precision"] is None and row["f1"] is None and row["accuracy"] == 0.5


def test_tied_scores_auc_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, score double")
    assert E.auc_score(df).collect()[0]["auc"] == 0.5


def _matrix_rows(tn, fp, fn, tp):
    return [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp


def test_published_confusion_matrices(spark):
    # Published matrices of the pandas half and their accuracy / F1 after rounding to 3.
    cases = [((3584, 500, 367, 3494), 0.891, 0.890),
             ((3578, 506, 723, 3138), 0.845, 0.836),
             ((2889, 1195, 1130, 2731), 0.707, 0.701),
             ((3390, 694, 555, 3306), 0.843, 0.841)]
    for (tn, fp, fn, tp), acc, f1 in cases:
        df = spark.createDataFrame(_matrix_rows(tn, fp, fn, tp), "label int, prediction int")
        m = E.classification_metrics(df).collect()[0]
        assert round(m["accuracy"], 3) == acc
        assert round(m["f1"], 3) == f1
        cm = {(r["label"], r["prediction"]): r["n"] for r in E.confusion_matrix(df).collect()}
        assert cm == {(0, 0): tn, (0, 1): fp, (1, 0): fn, (1, 1): tp}


def test_classification_report_rows(spark):
    df = spark.createDataFrame(_matrix_rows(3584, 500, 367, 3494), "label int, prediction int")
    rep = {r["row_name"]: r for r in E.classification_report(df).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rep["1"]["support"] == 3861 and rep["0"]["support"] == 4084
    assert abs(rep["macro avg"]["f1"] - (rep["0"]["f1"] + rep["1"]["f1"]) / 2) < 1e-12


def test_write_report_single_ordered_file(spark, tmp_dir):
    import glob
    from kestrel import tables as T
    from conftest import SMALL
    top = R.top_products(T.reviews_from_lineitem(spark, SMALL), T.metadata_from_part(spark, SMALL))
    rep = report.fixed_width_report(top, R.review_ranking_order())
    out = os.path.join(tmp_dir, "report")
    report.write_report(rep, out)
    files = glob.glob(os.path.join(out, "part-*"))
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert len(lines) == 16 and lines[0] == report.header_line()
    expected = [r["line"] for r in rep.orderBy("line_no").collect()]
    assert lines == expected
