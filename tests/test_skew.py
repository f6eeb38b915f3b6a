"""One key holding a third of the rows: results equal brute force on a small fixture."""

import itertools

from pyspark.sql import functions as F

from kestrel.operators import evaluation as E
from kestrel.operators import relational as R


def _skewed_reviews(spark, n=3000):
    # Product 7 holds a third of all reviews, spread over 3 days; others are sparse.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400 + 100).alias("asin"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("review_day"),
        ((F.col("id") % 5) + 1).cast("double").alias("overall"))


def test_top_products_with_hot_product(spark):
    reviews = _skewed_reviews(spark)
    meta = spark.range(500).select(F.col("id").alias("asin"),
                                   F.concat(F.lit("b"), (F.col("id") % 7).cast("string")).alias("brand"))
    meta = meta.unionByName(meta.withColumn("brand", F.lit("a")).where(F.col("asin") == 7))
    got = [tuple(r) for r in R.top_products(reviews, meta, k=5).collect()]
    pr, pm = reviews.toPandas(), meta.toPandas()
    g = pr.groupby(["asin", "review_day"]).overall.agg(["count", "mean"]).reset_index()
    b = pm.groupby("asin").brand.min().reset_index()
    j = g.merge(b, on="asin").sort_values(["count", "asin", "review_day"],
                                          ascending=[False, True, True]).head(5)
    want = [(int(r.asin), r.review_day, int(r["count"]), round(float(r["mean"]), 4), r.brand)
            for _, r in j.iterrows()]
    assert sorted(got) == sorted(want)
    assert ("a" in {w[4] for w in want if w[0] == 7})


def test_auc_with_hot_score(spark):
    # A third of the rows share one score; AUC equals the pairwise definition.
    rows = [(i % 2, 0.5 if i % 3 == 0 else (i * 37 % 101) / 101.0) for i in range(600)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = E.auc_score(df).collect()[0]["auc"]
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    credit = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    assert abs(got - credit / (len(pos) * len(neg))) < 1e-12


def test_per_day_top_k_with_hot_day(spark):
    reviews = _skewed_reviews(spark).withColumn(
        "review_day", F.when(F.col("asin") == 7, F.lit("2020-01-01").cast("date"))
        .otherwise(F.col("review_day")))
    g = R.group_count_avg(reviews)
    got = {(r["review_day"], r["asin"], r["rank"]) for r in
           R.top_k_per_group(g, 3, ["review_day"], [F.desc("num_reviews"), F.asc("asin")]).collect()}
    pg = g.toPandas().sort_values(["review_day", "num_reviews", "asin"], ascending=[True, False, True])
    pg["rank"] = pg.groupby("review_day").cumcount() + 1
    want = {(r.review_day, r.asin, r["rank"]) for _, r in pg[pg["rank"] <= 3].iterrows()}
    assert got == want
