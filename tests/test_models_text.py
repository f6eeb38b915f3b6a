"""Text models: fits in a session that has observed something, features without shuffles."""

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kestrel.functions import text as X
from kestrel.operators import features as V
from kestrel.operators import models as M
from kestrel.operators import trees as TR
from kestrel.plans import q_models as Q


def test_logistic_regression_after_an_observation(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    d = spark.createDataFrame([(i, float(i % 2), Vectors.dense([i % 2, i / 10.0])) for i in range(20)],
                              ["doc_id", "label", "features"])
    got = M.fit_predict("lr", d, d, ["doc_id"]).collect()
    assert len(got) == 20 and all(r.prediction == r.label for r in got)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("count, name", [(V.term_counts, "term"), (V.hashed_counts, "bucket")])
def test_terms_are_counted_where_the_rows_are(spark, count, name):
    rows = [(1, ["b", "a", "b", "é", None]), (2, []), (3, None), (4, ["a"]), (None, ["c", "c"])]
    d = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    want = {(1, "a", 1), (1, "b", 2), (1, "é", 1), (4, "a", 1), (None, "c", 2)}
    at = {t: HashingTF().indexOf(t) for t in "abcé"} if name == "bucket" else {t: t for t in "abcé"}
    got = count(d)
    assert shuffles(got) == 0
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((k, at[t], n) for k, t, n in want), key=str)
    twice = count(d.unionByName(d))  # the counts of equal keys are summed
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(((k, at[t], 2 * n) for k, t, n in want), key=str)


def test_hashed_weights_shuffle_no_posting(spark):
    d = spark.createDataFrame([(i, ["a", f"w{i}"]) for i in range(50)], "doc_id long, tokens array<string>")
    got = V.hashed_weights(d)
    assert shuffles(got) == 0 and got.count() == 100


def test_equal_texts_are_found_without_a_table_of_texts(spark, tmp_dir):
    texts = [(5, "a b"), (2, "a b"), (9, None), (7, None), (3, "c"), (3, "c"), (4, "c"), (8, "no label")]
    labels = [(5, 1), (2, 1), (9, 0), (7, 0), (3, 1), (4, 0), (3, 1)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    d.write.parquet(f"{tmp_dir}/documents.parquet")
    got = Q.labelled_docs(spark, tmp_dir)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a b", 1, 2), (None, 0, 7), ("c", 1, 3), ("c", 0, 4)], key=str)
    d.distinct().write.parquet(f"{tmp_dir}/once/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_dir}/once/labels.parquet")
    once = Q.labelled_docs(spark, f"{tmp_dir}/once")
    assert sorted(map(str, once.collect())) == sorted(map(str, got.collect()))
    assert "Aggregate" not in once._jdf.queryExecution().executedPlan().toString()


def test_levels_of_trees_shuffle_no_rows_by_key(spark, monkeypatch):
    rows = [(i, i % 2, i % 5 > 0, [(0, float(i % 2)), (1 + i % 3, 1.0 + i % 4)]) for i in range(60)]
    d = spark.createDataFrame(rows, f"key long, label int, train boolean, features {TR.FEATURES}").cache()
    plans, write = [], TR.materialize

    def written(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    options = dict(trees=3, bootstrap=True, subset=0.7)
    monkeypatch.setattr(TR, "materialize", written)
    leaves = sorted(TR.grow(d, 3, **options).collect())
    assert len(leaves) == 180 and not any("hashpartitioning(key" in p for p in plans)
    monkeypatch.setattr(TR, "materialize", write)
    monkeypatch.setattr(TR, "WALK", 1)   # written at every level
    monkeypatch.setattr(TR, "DRAWN", 0)  # features drawn row by row
    assert sorted(TR.grow(d, 3, **options).collect()) == leaves


def test_a_task_stems_a_word_once(spark, tmp_dir, monkeypatch):
    rows = [(1, ["caresses", "ponies", "ponies"], 1), (2, None, 0), (3, [], 1), (4, ["ponies", "yyyying", "a", "caresses"], None)]
    d = spark.createDataFrame(rows, "doc_id long, tokens array<string>, label int")
    for times in (1, 2):
        want = sorted(X.stem_tokens(d, times=times, keep=["label"]).collect())
        assert sorted(X.stem_tokens(d, times=times, strategy="dictionary", keep=["label"]).collect()) == want
    monkeypatch.setattr(X, "KNOWN_WORDS", 1)  # forgets words that it needs again
    assert sorted(X.stem_tokens(d, times=2, strategy="dictionary", keep=["label"]).collect()) == want
    spark.createDataFrame([(1, "Caresses, ponies"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    plans, write = [], Q.M.materialize
    monkeypatch.setattr(Q.M, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    got = Q.clean_labelled_tokens(spark, tmp_dir).select("doc_id", "clean_tokens").collect()
    assert sorted(map(tuple, got), key=str) == [(1, ["caress", "poni"]), (2, None)]
    assert "MapInArrow" in plans[-1]  # no rule of the stemmer runs for each token
