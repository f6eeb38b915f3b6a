"""Naive Bayes over the exact vocabulary, in long form.

A model is two small tables: statistics per (term) with a column per class, and one row
of class totals. Nothing is capped and no vocabulary reaches the driver; scoring joins the
terms of the documents with the term statistics, frequent terms by broadcast
(``features.join_term_stats``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.features import join_term_stats
from kestrel.operators.models import materialize

CLASSES = (0, 1)


def naive_bayes_scores(terms: DataFrame, docs: DataFrame, model: str = "multinomial",
                       smoothing: float = 1.0) -> DataFrame:
    """(doc_id, label, prediction, score) of the test documents.

    ``docs`` has (doc_id, label, split), ``terms`` (doc_id, label, split, term, n): n is a
    count or a weight; ``bernoulli`` looks at presence only. The vocabulary is that of all
    rows, as the reference fits its vectoriser before the split. ``score`` is the posterior
    of class 1, 1 / (1 + exp(s0 - s1)). A document without terms is decided by the priors.
    """
    train = terms.where(F.col("split") == "train")
    value = F.lit(1.0) if model == "bernoulli" else F.col("n").cast("double")
    stats = terms.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        *[F.sum(F.when((F.col("split") == "train") & (F.col("label") == c), value)
                 .otherwise(F.lit(0.0))).alias(f"w{c}") for c in CLASSES])
    stats = materialize(stats)
    total = stats.agg(F.count(F.lit(1)).alias("nv"), *[F.sum(f"w{c}").alias(f"tot{c}") for c in CLASSES]).first()
    sizes = docs.where(F.col("split") == "train") \
                .agg(*[F.count_if(F.col("label") == c).alias(f"n{c}") for c in CLASSES]).first()
    n = [float(sizes[f"n{c}"]) for c in CLASSES]
    prior = [F.log(F.lit(n[c] + smoothing)) - F.log(F.lit(sum(n) + smoothing * len(CLASSES))) for c in CLASSES]
    if model == "bernoulli":
        theta = [(F.col(f"w{c}") + smoothing) / F.lit(n[c] + 2 * smoothing) for c in CLASSES]
        weight = [F.log(t) - F.log(F.lit(1.0) - t) for t in theta]
        absent = stats.agg(*[F.sum(F.log(F.lit(1.0) - t)).alias(f"a{c}") for c, t in zip(CLASSES, theta)]).first()
        base = [prior[c] + F.lit(float(absent[f"a{c}"] or 0.0)) for c in CLASSES]
    else:
        weight = [F.col("n") * (F.log(F.col(f"w{c}") + smoothing)
                                - F.log(F.lit(float(total[f"tot{c}"] or 0.0) + smoothing * total["nv"])))
                  for c in CLASSES]
        base = prior
    test = terms.where(F.col("split") == "test").select("doc_id", "term", "n")
    sums = join_term_stats(test, stats).groupBy("doc_id").agg(
        *[F.sum(w).alias(f"s{c}") for c, w in zip(CLASSES, weight)])
    scored = docs.where(F.col("split") == "test").select("doc_id", "label").join(sums, "doc_id", "left")
    s = [base[c] + F.coalesce(f"s{c}", F.lit(0.0)) for c in CLASSES]
    return scored.select("doc_id", F.col("label").cast("int").alias("label"),
                         (s[1] > s[0]).cast("int").alias("prediction"),
                         (F.lit(1.0) / (F.lit(1.0) + F.exp(s[0] - s[1]))).alias("score"))
