"""Whole jobs of the reference (Q2, Q4, Q5); Q1 and Q3 live with their operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.operators import evaluation as E
from kestrel.operators import models as M
from kestrel.plans.catalog import register
from kestrel.plans.q_evaluation import model_comparison_table
from kestrel.plans.q_models import (FOREST, KMEANS_K, KMEANS_SEED, TREE_SQL, TREE_SEED, hashed_rows,
                                    overfit_predictions, text_features, tree_predictions)


@register("sentiment_pipeline")
def sentiment_pipeline(spark, sf_dir):
    """Q2: dedupe -> clean -> TF-IDF -> split -> LR, NB, DT, RF -> one metrics pass.

    The tokens are cleaned and hashed to 2^18 features once; all four models'
    test predictions are stacked and scored by a single aggregation.
    """
    feats = text_features(spark, sf_dir)
    train, test = (feats.where(F.col("split") == s) for s in ("train", "test"))
    preds = [M.fit_predict(name, train, test, ["doc_id"], seed=TREE_SEED) for name in ("lr", "nb")]
    rows = hashed_rows(feats)
    preds += [tree_predictions("dt", rows), tree_predictions("rf", rows, **FOREST)]
    stacked = preds[0]
    for p in preds[1:]:
        stacked = stacked.unionByName(p)
    # Predictions are written once; the metrics and the AUC read them from there.
    return model_comparison_table(M.materialize(stacked))


@register("overfit_job")
def overfit_job(spark, sf_dir):
    """Q4: trees of depth 1, 5, 32 -> train/test accuracy -> fit diagnosis."""
    acc = E.classification_metrics(overfit_predictions(spark, sf_dir), ["model", "split"])
    wide = acc.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("accuracy"))).alias("train_accuracy"),
        F.max(F.when(F.col("split") == "test", F.col("accuracy"))).alias("test_accuracy"))
    return E.fit_diagnosis(wide)


@register("clustering_job")
def clustering_job(spark, sf_dir):
    """Q5: k-means -> assignment -> per-cluster size and mean silhouette."""
    _, assigned = M.kmeans_fit(T.load(spark, sf_dir, "embeddings"), KMEANS_K, KMEANS_SEED)
    per_point = M.point_silhouettes(assigned, "cluster")
    return per_point.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_points"), F.avg("silhouette").alias("silhouette"))
