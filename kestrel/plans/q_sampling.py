"""Sampling, splitting and regression queries.

Regression input (one numeric feature, one numeric label): ``lineitem`` with feature
``l_quantity`` and label
``l_extendedprice``; its unique row key is the four-column key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.operators import evaluation as E
from kestrel.operators import regression as G
from kestrel.operators import sampling as S
from kestrel.plans.catalog import register

SPLIT_SEED = 0
SAMPLE_SEED = 42
# The reference's last learning-curve setting: 30 chunks, sizes 1,500 to 600,000.
CHUNKS, MIN_CHUNK, MAX_CHUNK = 30, 1500, 600000
SAMPLE_N = 1000

_KEY_SQL = ("(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || "
            "CAST(l_suppkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR))")


def weather(spark, sf_dir):
    w = T.load(spark, sf_dir, "lineitem").select(
        T.lineitem_row_key().alias("row_key"),
        F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return T.spread(w, "row_key")


WEATHER_SQL = f"(SELECT {_KEY_SQL} AS row_key, l_quantity AS x, l_extendedprice AS y FROM lineitem)"


def _exact_split_sql(table: str, key: str, seed: int, frac: float = 0.2) -> str:
    return f"""(SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR)), CAST({key} AS VARCHAR))
                      <= ceil(count(*) OVER () * {frac}) THEN 'test' ELSE 'train' END AS split
   FROM {table} t)"""


@register("random_split", f"""
SELECT doc_id, CASE WHEN substr(md5('{SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)), 1, 4) < '{S.split_threshold(0.8)}'
                    THEN 'train' ELSE 'test' END AS split
FROM documents""")
def random_split(spark, sf_dir):
    """Seeded 80/20 hash split of the documents."""
    return S.random_split(T.load(spark, sf_dir, "documents").select("doc_id"), "doc_id",
                          0.8, SPLIT_SEED)


@register("exact_split", f"""
SELECT doc_id, split FROM {_exact_split_sql("documents", "doc_id", SAMPLE_SEED)} s""")
def exact_split(spark, sf_dir):
    """R2: exactly ceil(0.2 n) test rows, the first in seeded hash order."""
    return S.exact_split(T.load(spark, sf_dir, "documents").select("doc_id"), "doc_id",
                         0.2, SAMPLE_SEED)


@register("sample_n", f"""
SELECT row_key, x, y, draw FROM (
  SELECT *, row_number() OVER (ORDER BY md5('{SAMPLE_SEED}:' || row_key), row_key) AS draw
  FROM {WEATHER_SQL} w) t WHERE draw <= {SAMPLE_N}""")
def sample_n(spark, sf_dir):
    """1,000 (feature, label) rows drawn together without replacement."""
    return S.sample_n(weather(spark, sf_dir), "row_key", SAMPLE_N, SAMPLE_SEED)


_SIZES_SQL = f"""(SELECT i AS chunk,
        CAST({MIN_CHUNK} + (i + 1) * floor((least(n, {MAX_CHUNK}) - {MIN_CHUNK}) / {CHUNKS}) AS BIGINT) AS size
   FROM (SELECT count(*) AS n FROM lineitem) c, range(0, {CHUNKS}) r(i))"""


@register("size_schedule", f"SELECT chunk, size FROM {_SIZES_SQL} s")
def size_schedule(spark, sf_dir):
    """The learning curve's sample sizes."""
    return S.size_schedule(T.load(spark, sf_dir, "lineitem"), CHUNKS, MIN_CHUNK, MAX_CHUNK)


def regression_split(spark, sf_dir):
    """Exact 80/20 split of the weather rows; their digests are computed once and written."""
    return S.exact_split(weather(spark, sf_dir), "row_key", 0.2, SAMPLE_SEED, written=True)


_REG_SQL = f"""
WITH s AS {_exact_split_sql(WEATHER_SQL, "row_key", SAMPLE_SEED)},
fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
               CAST(regr_count(y, x) AS BIGINT) AS n_train
        FROM s WHERE split = 'train'),
pred AS (SELECT s.row_key, s.y, fit.intercept + fit.slope * s.x AS p FROM s, fit WHERE split = 'test')
"""


@register("linear_regression", _REG_SQL + "SELECT slope, intercept, n_train FROM fit")
def linear_regression(spark, sf_dir):
    """K7: least-squares line on the train rows (regr_slope / regr_intercept)."""
    sp = regression_split(spark, sf_dir).where(F.col("split") == "train")
    return sp.agg(F.regr_slope("y", "x").alias("slope"),
                  F.regr_intercept("y", "x").alias("intercept"),
                  F.regr_count("y", "x").alias("n_train"))


def _test_predictions(spark, sf_dir):
    sp = regression_split(spark, sf_dir)
    slope, intercept, _ = G.fit_line(sp.where(F.col("split") == "train"), "x", "y")
    test = sp.where(F.col("split") == "test")
    return G.predict_line(test, "x", slope, intercept).withColumnRenamed("y", "label")


def _reg_metrics(spark, sf_dir):
    return E.regression_metrics(_test_predictions(spark, sf_dir))


@register("squared_error", _REG_SQL + """
SELECT row_key, (y - p) * (y - p) AS squared_error, abs(y - p) AS abs_error FROM pred""")
def squared_error(spark, sf_dir):
    """M1: per-row squared and absolute error of the fitted line on test rows."""
    p = _test_predictions(spark, sf_dir)
    err = F.col("label") - F.col("prediction")
    return p.select("row_key", (err * err).alias("squared_error"), F.abs(err).alias("abs_error"))


@register("rmse", _REG_SQL + "SELECT sqrt(avg((y - p) * (y - p))) AS rmse, avg((y - p) * (y - p)) AS mse FROM pred")
def rmse(spark, sf_dir):
    """Root mean squared error (and mse) on the test rows."""
    return _reg_metrics(spark, sf_dir).select("rmse", "mse")


@register("mae", _REG_SQL + "SELECT avg(abs(y - p)) AS mae FROM pred")
def mae(spark, sf_dir):
    return _reg_metrics(spark, sf_dir).select("mae")


@register("r2_score", _REG_SQL + """
SELECT 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM pred""")
def r2_score(spark, sf_dir):
    """1 - SSres / SStot with the test rows' own mean."""
    return _reg_metrics(spark, sf_dir).select("r2")


@register("regression_job", _REG_SQL + """
SELECT fit.slope, fit.intercept, fit.n_train, m.n, m.mse, m.rmse, m.mae, m.r2
FROM fit, (SELECT count(*) AS n, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
                  avg(abs(y - p)) AS mae,
                  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM pred) m""")
def regression_job(spark, sf_dir):
    """Q3: exact split -> line fit -> rmse, mae, r2 on the test rows."""
    sp = regression_split(spark, sf_dir)
    slope, intercept, n_train = G.fit_line(sp.where(F.col("split") == "train"), "x", "y")
    test = G.predict_line(sp.where(F.col("split") == "test"), "x", slope, intercept) \
            .withColumnRenamed("y", "label")
    m = E.regression_metrics(test)
    return m.select(F.lit(slope).alias("slope"), F.lit(intercept).alias("intercept"),
                    F.lit(n_train).cast("long").alias("n_train"),
                    "n", "mse", "rmse", "mae", "r2")


@register("learning_curve", f"""
WITH r AS (SELECT row_key, x, y,
                  row_number() OVER (ORDER BY md5('{SAMPLE_SEED}:' || row_key), row_key) AS draw,
                  CASE WHEN substr(md5('{SPLIT_SEED}:' || row_key), 1, 4) < '{S.split_threshold(0.8)}'
                       THEN 'train' ELSE 'test' END AS split
           FROM {WEATHER_SQL} w),
sizes AS {_SIZES_SQL},
fit AS (SELECT chunk, size, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
               count(*) AS n_train
        FROM sizes JOIN r ON r.draw <= sizes.size AND r.split = 'train' GROUP BY chunk, size)
SELECT fit.chunk, fit.size, fit.n_train, count(*) AS n_test, fit.slope, fit.intercept,
       sqrt(avg((r.y - (fit.intercept + fit.slope * r.x)) * (r.y - (fit.intercept + fit.slope * r.x)))) AS rmse
FROM fit JOIN r ON r.draw <= fit.size AND r.split = 'test'
GROUP BY fit.chunk, fit.size, fit.n_train, fit.slope, fit.intercept""")
def learning_curve(spark, sf_dir):
    """Test RMSE against sample size, all sizes in one aggregation pass."""
    return G.learning_curve(weather(spark, sf_dir), "row_key", "x", "y", CHUNKS, MIN_CHUNK,
                            MAX_CHUNK, SAMPLE_SEED, SPLIT_SEED)


@register("abs_error", _REG_SQL + "SELECT row_key, abs(y - p) AS abs_error FROM pred")
def abs_error(spark, sf_dir):
    """M1: per-row absolute error of the fitted line on the test rows."""
    p = _test_predictions(spark, sf_dir)
    return p.select("row_key", F.abs(F.col("label") - F.col("prediction")).alias("abs_error"))


@register("mse", _REG_SQL + "SELECT avg((y - p) * (y - p)) AS mse FROM pred")
def mse(spark, sf_dir):
    """Mean squared error on the test rows."""
    return _reg_metrics(spark, sf_dir).select("mse")
