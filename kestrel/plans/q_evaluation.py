"""Evaluation queries (E1-E14, E17) on rule models, so SQL can check every value.

Labelled text stands in for the reference's test set: ``label`` = ``quality``. Three
fixed rules play the models; their predictions are stacked as
``(model, doc_id, split, label, prediction, score)`` in one scan of the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.operators import evaluation as E
from kestrel.operators.sampling import random_split, split_threshold
from kestrel.plans.catalog import register

SPLIT_SEED = 0


def stacked_rule_predictions(spark, sf_dir):
    docs = T.labelled_text(spark, sf_dir).select(
        "doc_id", "n_chars", "lang", F.col("quality").alias("label"))
    docs = random_split(docs, "doc_id", 0.8, SPLIT_SEED)
    rules = F.array(
        F.struct(F.lit("long_text").alias("model"),
                 (F.col("n_chars") >= 500).cast("int").alias("prediction"),
                 F.col("n_chars").cast("double").alias("score")),
        F.struct(F.lit("english").alias("model"),
                 (F.col("lang") == "en").cast("int").alias("prediction"),
                 F.when(F.col("lang") == "en", 1.0).otherwise(0.0).alias("score")),
        F.struct(F.lit("short_text").alias("model"),
                 (F.col("n_chars") < 2000).cast("int").alias("prediction"),
                 (-F.col("n_chars")).cast("double").alias("score")),
    )
    return docs.select("doc_id", "split", "label", F.explode(rules).alias("r")) \
               .select(F.col("r.model").alias("model"), "doc_id", "split", "label",
                       F.col("r.prediction").alias("prediction"), F.col("r.score").alias("score"))


def stacked_sql(by: str = "model", where: str = "TRUE") -> str:
    """CTEs ``docs``, ``stacked``, ``counts`` (tp/fp/fn/tn grouped ``by``, rows ``where``)
    and ``metrics``; the SQL twin of ``stacked_rule_predictions``."""
    return f"""
WITH docs AS (
  SELECT d.doc_id, d.n_chars, d.lang, l.quality AS label,
         CASE WHEN substr(md5('{SPLIT_SEED}:' || CAST(d.doc_id AS VARCHAR)), 1, 4) < '{split_threshold(0.8)}'
              THEN 'train' ELSE 'test' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
stacked AS (
  SELECT 'long_text' AS model, doc_id, split, label, CAST(n_chars >= 500 AS INT) AS prediction,
         CAST(n_chars AS DOUBLE) AS score FROM docs
  UNION ALL
  SELECT 'english', doc_id, split, label, CAST(lang = 'en' AS INT),
         CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END FROM docs
  UNION ALL
  SELECT 'short_text', doc_id, split, label, CAST(n_chars < 2000 AS INT),
         CAST(-n_chars AS DOUBLE) FROM docs),
counts AS (
  SELECT {by},
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn
  FROM stacked WHERE {where} GROUP BY {by}),
metrics AS (
  SELECT {by},
         (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy,
         CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) END AS precision,
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END AS recall
  FROM counts)
"""


STACKED_SQL = stacked_sql()


def _auc_cte(score: str, where: str = "TRUE") -> str:
    """CTE ``auc(model, auc)``: tie-aware rank statistic per model."""
    return f"""
, sc AS (SELECT model, {score} AS s, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
         FROM stacked WHERE {where} GROUP BY model, {score}),
rn AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc),
auc AS (SELECT model, CASE WHEN sum(pos) * sum(neg) > 0
                           THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc
        FROM rn GROUP BY model)
"""


def _auc_sql(score: str, where: str = "TRUE") -> str:
    return _auc_cte(score, where) + "SELECT model, auc FROM auc"


@register("confusion_matrix", STACKED_SQL + """
SELECT model, 0 AS label, 0 AS prediction, tn AS n FROM counts UNION ALL
SELECT model, 0, 1, fp FROM counts UNION ALL
SELECT model, 1, 0, fn FROM counts UNION ALL
SELECT model, 1, 1, tp FROM counts""")
def confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(stacked_rule_predictions(spark, sf_dir), ["model"])


@register("accuracy", STACKED_SQL + "SELECT model, accuracy FROM metrics")
def accuracy(spark, sf_dir):
    return E.classification_metrics(stacked_rule_predictions(spark, sf_dir), ["model"]) \
            .select("model", "accuracy")


@register("precision_score", STACKED_SQL + "SELECT model, precision FROM metrics")
def precision_score(spark, sf_dir):
    return E.classification_metrics(stacked_rule_predictions(spark, sf_dir), ["model"]) \
            .select("model", "precision")


@register("recall_score", STACKED_SQL + "SELECT model, recall FROM metrics")
def recall_score(spark, sf_dir):
    return E.classification_metrics(stacked_rule_predictions(spark, sf_dir), ["model"]) \
            .select("model", "recall")


@register("f1_score", STACKED_SQL + """
SELECT model, CASE WHEN precision + recall > 0
                   THEN 2 * precision * recall / (precision + recall) END AS f1 FROM metrics""")
def f1_score(spark, sf_dir):
    return E.classification_metrics(stacked_rule_predictions(spark, sf_dir), ["model"]) \
            .select("model", "f1")


@register("classification_report", STACKED_SQL + """
, pc AS (SELECT model, tp::DOUBLE tp, fp::DOUBLE fp, fn::DOUBLE fn, tn::DOUBLE tn FROM counts),
cls AS (
  SELECT model, '0' AS row_name,
         coalesce(CASE WHEN tn + fn > 0 THEN tn / (tn + fn) END, 0) AS p,
         coalesce(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END, 0) AS r, tn + fp AS support FROM pc
  UNION ALL
  SELECT model, '1', coalesce(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 0),
         coalesce(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 0), tp + fn FROM pc),
cf AS (SELECT *, coalesce(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END, 0) AS f FROM cls)
SELECT model, row_name, p AS precision, r AS recall, f AS f1, CAST(support AS BIGINT) AS support FROM cf
UNION ALL
SELECT model, 'accuracy', NULL, NULL, (tp + tn) / (tp + fp + fn + tn), CAST(tp + fp + fn + tn AS BIGINT) FROM pc
UNION ALL
SELECT model, 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM cf GROUP BY model
UNION ALL
SELECT model, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
       sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM cf GROUP BY model""")
def classification_report(spark, sf_dir):
    return E.classification_report(stacked_rule_predictions(spark, sf_dir), ["model"])


@register("roc_curve", STACKED_SQL + """
, sc AS (SELECT model, score AS s, sum(label) AS pos, sum(1 - label) AS neg
         FROM stacked GROUP BY model, score),
rn AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY s DESC) AS tp,
                 sum(neg) OVER (PARTITION BY model ORDER BY s DESC) AS fp,
                 sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n,
                 lag(s) OVER (PARTITION BY model ORDER BY s DESC) AS above,
                 lead(pos) OVER (PARTITION BY model ORDER BY s DESC) AS pos2,
                 lead(neg) OVER (PARTITION BY model ORDER BY s DESC) AS neg2
       FROM sc)
SELECT model, s AS threshold, CASE WHEN n > 0 THEN fp::DOUBLE / n END AS fpr,
       CASE WHEN p > 0 THEN tp::DOUBLE / p END AS tpr FROM rn
WHERE above IS NULL OR pos2 IS NULL OR pos <> pos2 OR neg <> neg2""")
def roc_curve(spark, sf_dir):
    return E.roc_curve(stacked_rule_predictions(spark, sf_dir), ["model"])


@register("auc_score", STACKED_SQL + _auc_sql("score"))
def auc_score(spark, sf_dir):
    return E.auc_score(stacked_rule_predictions(spark, sf_dir), ["model"])


@register("auc_hard_label", STACKED_SQL + _auc_sql("CAST(prediction AS DOUBLE)"))
def auc_hard_label(spark, sf_dir):
    """AUC of the 0/1 prediction itself, (tpr + tnr) / 2."""
    return E.auc_hard_label(stacked_rule_predictions(spark, sf_dir), ["model"])


@register("auc_constant", STACKED_SQL + _auc_sql("0.0"))
def auc_constant(spark, sf_dir):
    """An all-zero predictor scores 0.5."""
    return E.auc_constant(stacked_rule_predictions(spark, sf_dir), ["model"])


_SPLIT_COUNTS = stacked_sql(by="model, split")


@register("train_test_accuracy", _SPLIT_COUNTS + """
SELECT model, split, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy FROM counts""")
def train_test_accuracy(spark, sf_dir):
    """Accuracy of each model on its train and test rows."""
    return E.classification_metrics(stacked_rule_predictions(spark, sf_dir), ["model", "split"]) \
            .select("model", "split", "accuracy")


def _accuracy_table(spark, sf_dir):
    acc = E.classification_metrics(stacked_rule_predictions(spark, sf_dir), ["model", "split"])
    return acc.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("accuracy"))).alias("train_accuracy"),
        F.max(F.when(F.col("split") == "test", F.col("accuracy"))).alias("test_accuracy"))


@register("fit_diagnosis", _SPLIT_COUNTS + """
, acc AS (SELECT model,
                 max(CASE WHEN split = 'train' THEN (tp + tn)::DOUBLE / (tp + fp + fn + tn) END) AS train_accuracy,
                 max(CASE WHEN split = 'test' THEN (tp + tn)::DOUBLE / (tp + fp + fn + tn) END) AS test_accuracy
          FROM counts GROUP BY model),
best AS (SELECT max(test_accuracy) AS bt, arg_max(train_accuracy, (test_accuracy, model)) AS btrain FROM acc)
SELECT model, train_accuracy, test_accuracy,
       CASE WHEN test_accuracy = bt THEN 'best'
            WHEN train_accuracy > btrain THEN 'overfit' ELSE 'underfit' END AS diagnosis
FROM acc, best""")
def fit_diagnosis(spark, sf_dir):
    return E.fit_diagnosis(_accuracy_table(spark, sf_dir))


@register("model_comparison", stacked_sql(where="split = 'test'")
          + _auc_cte("score", "split = 'test'") + """
SELECT m.model, m.accuracy * 100 AS accuracy, m.precision * 100 AS precision,
       m.recall * 100 AS recall,
       CASE WHEN m.precision + m.recall > 0
            THEN 2 * m.precision * m.recall / (m.precision + m.recall) * 100 END AS f1,
       a.auc * 100 AS auc
FROM metrics m JOIN auc a ON m.model = a.model""")
def model_comparison(spark, sf_dir):
    """The five metrics of every model on its test rows, in percent."""
    s = stacked_rule_predictions(spark, sf_dir).where(F.col("split") == "test")
    return model_comparison_table(s)


def model_comparison_table(stacked):
    m = E.classification_metrics(stacked, ["model"])
    a = E.auc_score(stacked, ["model"])
    j = m.join(a, "model")
    return j.select("model", *[(F.col(c) * F.lit(100.0)).alias(c)
                              for c in ("accuracy", "precision", "recall", "f1", "auc")])
