"""Model evaluation as DataFrame aggregations.

Metric operators take columns ``label`` (0/1), ``prediction`` (0/1) and, for ranking
metrics, ``score``; ``by`` names grouping columns such as ``model`` or ``split`` so that
many models are scored in one pass over stacked predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.ordering import neighbours, running_sums
from kestrel.session import materialize


def _is(c: str, v: int) -> Column:
    return F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0))


def confusion_counts(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """tp, fp, fn, tn per group in one pass of conditional sums."""
    pos_l, pos_p = F.col(label) == 1, F.col(prediction) == 1
    neg_l, neg_p = F.col(label) == 0, F.col(prediction) == 0

    def cnt(cond: Column) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    return df.groupBy(*by).agg(
        cnt(pos_l & pos_p).alias("tp"), cnt(neg_l & pos_p).alias("fp"),
        cnt(pos_l & neg_p).alias("fn"), cnt(neg_l & neg_p).alias("tn"))


def confusion_matrix(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Rows ``(label, prediction, n)`` for all four cells, empty cells as 0."""
    c = confusion_counts(df, by, label, prediction)
    return c.selectExpr(*by, "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) "
                             "AS (label, prediction, n)")


def metrics_from_counts(c: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 (E2-E5). A zero denominator gives null, where
    the hand-written formula of the reference would divide by zero."""
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    return c.select(
        *by,
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
    )


def classification_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    return metrics_from_counts(confusion_counts(df, by, label, prediction), by)


def classification_report(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, f1 and support, then accuracy, macro and weighted
    averages (E6), as rows ``(row_name, precision, recall, f1, support)``."""
    c = confusion_counts(df, by, label, prediction)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))

    def prf(t, f_p, f_n):
        p = F.coalesce(F.try_divide(t, t + f_p), F.lit(0.0))
        r = F.coalesce(F.try_divide(t, t + f_n), F.lit(0.0))
        f = F.coalesce(F.try_divide(F.lit(2.0) * p * r, p + r), F.lit(0.0))
        return p, r, f

    p1, r1, f1 = prf(tp, fp, fn)          # class 1
    p0, r0, f0 = prf(tn, fn, fp)          # class 0 seen as the positive class
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = F.try_divide(tp + tn, n)
    wide = c.select(*by, p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
                    p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
                    acc.alias("acc"), n.alias("n"))
    return wide.selectExpr(*by, """stack(5,
        '0', p0, r0, f0, s0,
        '1', p1, r1, f1, s1,
        'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,
        'macro avg', (p0 + p1) / 2D, (r0 + r1) / 2D, (f0 + f1) / 2D, n,
        'weighted avg', try_divide(p0 * s0 + p1 * s1, n), try_divide(r0 * s0 + r1 * s1, n),
                        try_divide(f0 * s0 + f1 * s1, n), n)
        AS (row_name, precision, recall, f1, support)""") \
        .withColumn("support", F.col("support").cast("long"))


def _score_counts(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; partial aggregation first, so a score
    shared by a third of the rows is one row after the map side."""
    return df.groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.sum(_is(label, 1)).cast("long").alias("pos"),
        F.sum(_is(label, 0)).cast("long").alias("neg"))


def roc_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label",
              score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at the corners of the curve (E7): rows with score >= threshold
    count as predicted positive.

    A point between two equal steps is left out, as the reference's default does: a distinct
    score stays if it is the highest or the lowest, or if its positives and negatives differ
    from those of the next lower score. The points left out lie on a straight line.

    Running sums are computed two-phase; a score's neighbours are found per range of scores,
    and ranges exchange only their edges, so no window holds a whole curve."""
    sc = materialize(_score_counts(df, by, label, score))  # read for cut points and sums
    r = running_sums(sc, [F.col("_s")], ["pos", "neg"], by, keep_bucket="_range")
    r = neighbours(r, by, "_range", "_s", ["pos", "neg"])
    tp = F.col("tot_pos") - F.col("run_pos") + F.col("pos")
    fp = F.col("tot_neg") - F.col("run_neg") + F.col("neg")
    # The step to this point is (neg, pos), the step to the point after it the next lower score's.
    corner = F.col("below_pos").isNull() | F.col("above").isNull() | \
        (F.col("pos") != F.col("below_pos")) | (F.col("neg") != F.col("below_neg"))
    return r.where(corner).select(
        *by, F.col("_s").alias("threshold"),
        F.try_divide(fp.cast("double"), F.col("tot_neg").cast("double")).alias("fpr"),
        F.try_divide(tp.cast("double"), F.col("tot_pos").cast("double")).alias("tpr"))


def auc_hard_label(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """AUC of the 0/1 prediction itself (E9): (tpr + tnr) / 2, null without one of the
    classes. A closed form of the confusion counts: no ranks."""
    def share(value: int) -> Column:
        own = F.col(label) == value
        return F.try_divide(F.count_if(own & (F.col(prediction) == value)).cast("double"),
                            F.count_if(own).cast("double"))

    return df.groupBy(*by).agg(((share(1) + share(0)) / F.lit(2.0)).alias("auc"))


def auc_constant(df: DataFrame, by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """AUC of a constant score (E9): one half wherever both classes occur."""
    both = (F.count_if(F.col(label) == 1) > 0) & (F.count_if(F.col(label) == 0) > 0)
    return df.groupBy(*by).agg(F.when(both, F.lit(0.5)).alias("auc"))


def auc_score(df: DataFrame, by: Sequence[str] = (), label: str = "label",
              score: str = "score") -> DataFrame:
    """Area under the ROC curve (E8): sum over positives of the negatives scored lower,
    plus half the tied ones, over P*N. Equal to the trapezoid area of ``roc_curve``."""
    sc = materialize(_score_counts(df, by, label, score))
    r = running_sums(sc, [F.col("_s")], ["neg"], by)
    below = (F.col("run_neg") - F.col("neg")).cast("double")
    credit = F.col("pos").cast("double") * (below + F.col("neg").cast("double") / F.lit(2.0))
    return r.groupBy(*by).agg(
        F.try_divide(F.sum(credit),
                     F.sum("pos").cast("double") * F.first("tot_neg").cast("double"))
        .alias("auc"))


def regression_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """n, mse, rmse, mae, r2 (E10-E12, M1) in one pass.

    r2 uses the population variance of the label (a stable merge of partial moments),
    not ``regr_r2``, which is a squared correlation.
    """
    err = F.col(label) - F.col(prediction)
    sse = F.sum(err * err)
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        n.alias("n"),
        (sse / n).alias("mse"),
        F.sqrt(sse / n).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, F.var_pop(label) * n)).alias("r2"),
    )


def fit_diagnosis(acc: DataFrame, model: str = "model") -> DataFrame:
    """Label each model from its train and test accuracy.

    ``acc`` has one row per model with ``train_accuracy`` and ``test_accuracy``. The
    best model has the highest test accuracy; a model that trails it on test but beats
    it on train over-fits; any other trails on both and under-fits. The table has one
    row per model, so the window is small.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(F.lit(0))
    best_test = F.max("test_accuracy").over(w)
    best_row = F.max_by(F.struct("train_accuracy"),
                        F.struct("test_accuracy", F.col(model).cast("string"))).over(w)
    return acc.select(
        "*",
        F.when(F.col("test_accuracy") == best_test, F.lit("best"))
         .when(F.col("train_accuracy") > best_row["train_accuracy"], F.lit("overfit"))
         .otherwise(F.lit("underfit")).alias("diagnosis"))
