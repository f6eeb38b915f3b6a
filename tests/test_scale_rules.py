"""Results that don't depend on settings, and plans without whole-table shuffles."""

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from kestrel.operators import evaluation as E
from kestrel.operators import features as V
from kestrel.operators import sampling as S
from kestrel.plans import q_sampling


@pytest.mark.parametrize("partitions", ["1", "16", "100"])
def test_split_and_sample_for_any_partition_count(spark, partitions):
    d = spark.range(5000).withColumnRenamed("id", "k")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        split = S.exact_split(d, "k", 0.2, 42)
        assert split.where("split = 'test'").count() == 1000
        assert split.where("split = 'test'").agg(F.sum("k")).first()[0] == \
            sum(sorted(range(5000), key=lambda i: __import__("hashlib").md5(f"42:{i}".encode()).hexdigest())[:1000])
        draws = [r.draw for r in S.sample_n(d, "k", 77, 42).orderBy("draw").collect()]
        assert draws == list(range(1, 78))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cuts_before_and_beyond_the_rows(spark):
    d = spark.range(10).withColumnRenamed("id", "k")
    assert S.hash_cuts(d, "k", 1, [0, 11])[1] is None
    assert d.where(S.up_to(S.hash_cuts(d, "k", 1, [0])[0], "k", 1)).count() == 0
    assert d.where(S.up_to(S.hash_cuts(d, "k", 1, [4])[0], "k", 1)).count() == 4
    assert S.exact_split(d.limit(0), "k").count() == 0 and S.sample_n(d, "k", 50).count() == 10


def test_split_plan_has_no_shuffle(spark):
    plan = q_sampling.regression_split(spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Sort" not in plan


def test_schedule_with_fewer_rows_than_the_least_size(spark):
    sizes = S.size_schedule(spark.range(20), 5, 100, 1000).collect()
    assert [r["size"] for r in sizes] == [100] * 5


@pytest.mark.parametrize("hot_terms", [1, 3, 10_000])
def test_hot_terms_change_nothing(spark, hot_terms):
    rows = [(d, "the", 1) for d in range(200)] + [(d, f"t{d % 7}", 2) for d in range(200)]
    tf = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    got = V.join_term_stats(tf, stats, hot_terms)
    assert got.exceptAll(tf.join(stats, "term").select(got.columns)).isEmpty() and got.count() == 400


def test_closed_form_aucs_equal_ranked_ones(spark):
    rows = [("a", i % 2, (i // 3) % 2, float((i // 3) % 2)) for i in range(50)] + [("b", 1, 0, 0.0)]
    d = spark.createDataFrame(rows, "model string, label int, prediction int, score double")
    ranked = {r.model: r.auc for r in E.auc_score(d, ["model"]).collect()}
    closed = {r.model: r.auc for r in E.auc_hard_label(d, ["model"]).collect()}
    assert closed["a"] == pytest.approx(ranked["a"]) and closed["b"] is None and ranked["b"] is None
    assert {r.model: r.auc for r in E.auc_constant(d, ["model"]).collect()} == {"a": 0.5, "b": None}


def test_term_statistics_are_joined_without_sorting_postings(spark):
    tf = spark.sql("SELECT id AS doc_id, concat('t', id % 7) AS term, id AS tf FROM range(70)")
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = V.join_term_stats(tf, stats, hot_terms=1)  # no term is hot
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted((r.doc_id, r.term, r.tf, r.df) for r in found.collect()) == \
            [(i, f"t{i % 7}", i, 10) for i in range(70)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
