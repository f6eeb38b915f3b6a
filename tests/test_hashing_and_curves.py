"""Hashed terms against Spark ML, thinned ROC points, digests computed once."""

import random

import numpy as np
from pyspark.ml.feature import HashingTF, IDF
from pyspark.sql import functions as F

from conftest import SMALL
from kestrel.operators import evaluation as E
from kestrel.operators import features as V
from kestrel.operators import ordering as O
from kestrel.operators import sampling as S
from kestrel.plans import q_sampling

WORDS = ["", "a", "ab", "abc", "abcd", "abcde", "né", "日本語", "😀", "x" * 41, "the", "The", "été" * 9, "\x00", "a\nb"]


def test_buckets_equal_those_of_spark_ml(spark):
    rng = random.Random(3)
    words = WORDS + ["".join(chr(rng.choice([97, 233, 0x4E00, 0x1F600])) for _ in range(rng.randint(1, 13))) for _ in range(60)]
    for n in (1 << 18, 1000):
        hashing = HashingTF(numFeatures=n)
        d = spark.createDataFrame([(w,) for w in words], "w string")
        got = {r.w: r.b for r in d.select("w", V.murmur3_bucket("w", n).alias("b")).collect()}
        assert got == {w: hashing.indexOf(w) for w in words}


def test_weights_equal_those_of_spark_ml(spark):
    docs = [(1, ["a", "b", "a", "né"]), (2, ["b"]), (3, []), (4, ["c", "a"]), (5, None)]
    d = spark.createDataFrame(docs, "doc_id long, tokens array<string>")
    got = {(r.doc_id, r.bucket): (r.tf, round(r.weight, 12)) for r in V.hashed_weights(d, num_features=64).collect()}
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=64).transform(d.where("tokens is not null"))
    model = IDF(inputCol="tf", outputCol="w").fit(tf)
    idf = np.log((5 + 1) / (np.array(model.docFreq) + 1))  # the fifth document has no terms
    want = {(r.doc_id, int(i)): (int(v), round(float(v * idf[i]), 12))
            for r in tf.collect() for i, v in zip(r.tf.indices, r.tf.values)}
    assert got == want


def corners(rows):
    """Distinct scores from above; a point between two equal steps goes."""
    steps = []
    for s in sorted({s for _, s in rows}, reverse=True):
        steps.append((s, sum(1 for y, t in rows if t == s and y), sum(1 for y, t in rows if t == s and not y)))
    keep = [i for i in range(len(steps)) if i in (0, len(steps) - 1) or steps[i][1:] != steps[i + 1][1:]]
    p, n = sum(a for _, a, _ in steps), sum(b for _, _, b in steps)
    return sorted((steps[i][0], sum(b for _, _, b in steps[:i + 1]) / n, sum(a for _, a, _ in steps[:i + 1]) / p) for i in keep)


def test_roc_keeps_corners_only_across_ranges(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(int(s % 20 < 12), float(s)) for s in range(200)] + [(rng.randint(0, 1), float(rng.randint(0, 250))) for _ in range(60)]
    d = spark.createDataFrame(rows, "label int, score double").withColumn("m", F.lit("x"))
    want = corners(rows)
    assert len(want) < len({s for _, s in rows})
    for by in ((), ("m",)):
        for buckets in (2, 7, 40):
            monkeypatch.setattr(O, "default_buckets", lambda df, n=buckets: n)
            got = sorted((r.threshold, r.fpr, r.tpr) for r in E.roc_curve(d, by).collect())
            assert got == want


def test_digests_are_computed_once_a_row(spark):
    curve = q_sampling.learning_curve(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert curve.count("md5(") <= 2  # the draw and the split
    d = spark.range(1000)
    split = S.exact_split(d, "id")._jdf.queryExecution().executedPlan().toString()
    assert split.count("md5(") == 1
