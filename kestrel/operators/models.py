"""Model fitting and scoring through Spark ML.

Fitting is the only place where results reach the driver, and only as model
parameters. Predictions stay DataFrames, stacked as
``(model, <key>, label, prediction, score)`` so that one aggregation scores them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression, LogisticRegressionModel,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Binarizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize, scratch_path  # noqa: F401

MAX_CLUSTERS = 256


def classifier(name: str, features: str = "features", label: str = "label", seed: int = 0,
               max_depth: int = 5, reg_param: float = 0.0, num_trees: int = 20,
               max_bins: int = 32, aggregation_depth: int = 2):
    """The estimators of the reference with Spark ML defaults (seeds made explicit).

    ``aggregation_depth`` sets how gradients are summed: a deeper tree for many partitions
    and wide features."""
    if name == "lr":
        return LogisticRegression(featuresCol=features, labelCol=label, maxIter=100,
                                  regParam=reg_param, aggregationDepth=aggregation_depth)
    if name == "nb":
        return NaiveBayes(featuresCol=features, labelCol=label, modelType="multinomial",
                          smoothing=1.0)
    if name == "nb_bernoulli":
        return NaiveBayes(featuresCol="_binary", labelCol=label, modelType="bernoulli",
                          smoothing=1.0)
    if name == "dt":
        return DecisionTreeClassifier(featuresCol=features, labelCol=label,
                                      maxDepth=max_depth, maxBins=max_bins, seed=seed)
    if name == "rf":
        return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                      maxDepth=max_depth, maxBins=max_bins, seed=seed)
    raise ValueError(name)


def reloaded(model: LogisticRegressionModel, df: DataFrame) -> LogisticRegressionModel:
    """``model`` written to the shared folder and read back, which leaves its training summary
    behind: that refers to the session, and a session in which an ``Observation`` ran (or jobs
    were tagged) can't be sent to tasks."""
    path = scratch_path(df.sparkSession, "model")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def fit_predict(name: str, train: DataFrame, test: DataFrame, keep: Sequence[str],
                features: str = "features", label: str = "label", seed: int = 0,
                max_depth: int = 5, **params) -> DataFrame:
    """Fit on ``train``; return ``(model, keep..., label, prediction, score)`` for
    ``test`` where ``score`` is the positive-class probability (K10, P8)."""
    est = classifier(name, features, label, seed, max_depth, **params)
    if name == "nb_bernoulli":
        # Bernoulli NB accepts only 0/1 values: presence of a term.
        binar = Binarizer(threshold=0.0, inputCol=features, outputCol="_binary")
        train, test = binar.transform(train), binar.transform(test)
    model = est.fit(train)
    if name == "lr":
        model = reloaded(model, train)
    pred = model.transform(test)
    return pred.select(
        F.lit(name).alias("model"), *keep, F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"))


def kmeans_fit(points: DataFrame, k: int, seed: int, vector_col: str = "embedding"):
    """K-means (K8) on an ``array<float>`` column."""
    feats = points.withColumn("_features", array_to_vector(vector_col))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(feats)
    return model, model.transform(feats).drop("_features")


def kmeans_centers(model, spark) -> DataFrame:
    """Cluster centres (K9) as rows ``(cluster, dim, center)``: k x d values."""
    rows = [(i, j, float(v)) for i, c in enumerate(model.clusterCenters())
            for j, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, dim int, center double")


def group_means(points: DataFrame, group: str, vector_col: str = "embedding") -> DataFrame:
    """Per-dimension mean of each group (K9 mean form): ``(group, dim, mean)``."""
    return (points.select(group, F.posexplode(vector_col).alias("dim", "v"))
                  .groupBy(group, "dim").agg(F.avg(F.col("v").cast("double")).alias("mean")))


def mean_silhouette(points: DataFrame, cluster: str, vector_col: str = "embedding") -> DataFrame:
    """Mean silhouette with squared Euclidean distance (E16), by Spark ML's evaluator."""
    vectors = points.select(array_to_vector(F.col(vector_col).cast("array<double>")).alias("_x"),
                            F.col(cluster).cast("double").alias("_c"))
    value = ClusteringEvaluator(featuresCol="_x", predictionCol="_c", metricName="silhouette",
                                distanceMeasure="squaredEuclidean").evaluate(vectors)
    return points.sparkSession.createDataFrame([(float(value),)], "silhouette double")


def point_silhouettes(points: DataFrame, cluster: str, vector_col: str = "embedding") -> DataFrame:
    """``points`` with the silhouette of every row (squared Euclidean distance), in
    O(n * k * d); the evaluator of Spark ML only has the mean.

    The mean squared distance from x to the points of cluster C is
    ``||x||^2 - 2 x . S_C / N_C + Q_C / N_C`` with S_C the vector sum, Q_C the sum of
    squared norms and N_C the size of C; for x's own cluster it is rescaled by
    N/(N-1) to leave x itself out. Only these k-cluster statistics (k x d numbers)
    are gathered; no pair of points is ever formed. A point alone in its cluster scores 0.
    At most ``MAX_CLUSTERS`` clusters: the statistics become expressions.
    """
    pts = points.select(cluster, F.col(vector_col).cast("array<double>").alias("_x"))
    squares = F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v * v)
    rows = pts.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.sum(squares).alias("q"),
        Summarizer.sum(array_to_vector("_x")).alias("s")).take(MAX_CLUSTERS + 1)
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters in {cluster}")
    stats = {r[cluster]: {"n": r["n"], "q": r["q"], "s": dict(enumerate(r["s"]))} for r in rows}
    keys = sorted(stats)
    norm2 = F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v * v)
    d = pts.withColumn("_n2", norm2)
    for i, c in enumerate(keys):
        st = stats[c]
        dim = max(st["s"]) + 1 if st.get("s") else 0
        s_vec = F.array(*[F.lit(float(st["s"].get(j, 0.0))) for j in range(dim)])
        dot = F.aggregate(F.zip_with("_x", s_vec, lambda a, b: a * b), F.lit(0.0),
                          lambda acc, v: acc + v)
        mean_d = (F.col("_n2") - F.lit(2.0) * dot / F.lit(float(st["n"]))
                  + F.lit(float(st["q"]) / st["n"]))
        own = F.col(cluster) == F.lit(c)
        n = float(st["n"])
        a_part = F.when(own, F.when(F.lit(n) > 1, mean_d * F.lit(n / max(n - 1.0, 1.0))))
        d = d.withColumn(f"_a{i}", a_part).withColumn(
            f"_b{i}", F.when(~own, mean_d))
    a = F.coalesce(*[F.col(f"_a{i}") for i in range(len(keys))])
    b = F.least(*[F.col(f"_b{i}") for i in range(len(keys))]) if len(keys) > 1 else F.lit(None)
    own_n = F.coalesce(*[F.when(F.col(cluster) == F.lit(c), F.lit(stats[c]["n"]))
                         for c in keys])
    s = (F.when(own_n <= 1, F.lit(0.0))
          .when(a < b, F.lit(1.0) - a / b)
          .when(a > b, b / a - F.lit(1.0))
          .otherwise(F.lit(0.0)))
    return d.withColumn("silhouette", s) \
            .drop("_x", "_n2", *[f"_a{i}" for i in range(len(keys))], *[f"_b{i}" for i in range(len(keys))])
