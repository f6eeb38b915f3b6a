"""One-feature least squares (K7) and the learning curve (E15) as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.sampling import count_before, hash_cuts, random_split, with_digest


def fit_line(train: DataFrame, x: str, y: str) -> tuple[float, float, int]:
    """(slope, intercept, n) of the least-squares line y = intercept + slope * x.

    One aggregation; only the two coefficients reach the driver, as with any fitted
    model. For more than one feature use ``pyspark.ml.regression.LinearRegression``.
    """
    r = train.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"),
                  F.regr_count(y, x).alias("n")).first()
    return float(r["b"]), float(r["a"]), int(r["n"])


def predict_line(df: DataFrame, x: str, slope: float, intercept: float,
                 out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.lit(intercept) + F.lit(slope) * F.col(x).cast("double"))


def learning_curve(df: DataFrame, key: str, x: str, y: str, chunks: int, min_size: int,
                   max_size: int, sample_seed: int = 42, split_seed: int = 0,
                   train_fraction: float = 0.8) -> DataFrame:
    """Test RMSE of a line fitted on growing samples (E15), in one pass.

    Samples of every size are prefixes of one seeded hash order, so they are nested: each
    row is tagged with the first chunk whose sample holds it, the sufficient statistics
    (n, sums of x, y, x^2, xy, y^2) are summed per (chunk, split), and a running sum over
    the few chunks gives every sample's statistics. Train/test membership is a hash split
    and so stays the same for a row in every sample; its seed must differ from the
    sample seed, or the split would follow the draw order. x and y are centred on their means
    first to keep the sums well conditioned.
    """
    # One aggregation gives the row count (for the sizes) and the centring means.
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("cx"),
                   F.avg(y).alias("cy")).first()
    rows, cx, cy = int(stats["n"]), float(stats["cx"] or 0.0), float(stats["cy"] or 0.0)
    step_n = max(0, (min(rows, max_size) - min_size) // chunks)
    schedule = [min_size + (i + 1) * step_n for i in range(chunks)]
    cuts = hash_cuts(df, key, sample_seed, schedule)
    ranked = random_split(df.select(key, x, y), key, train_fraction, split_seed, "_split")
    # The digest is a column of its own, below the projection that compares it: computed once
    # a row, then a balanced search over the cuts. A cut of None lies behind every row.
    ranked = with_digest(ranked, key, sample_seed, "_h", "_k")
    ends = [c for c in cuts if c is not None]
    chunk = count_before(ends, 0, len(ends), F.col("_h"), F.col("_k")).cast("long")
    xc = F.col(x).cast("double") - F.lit(cx)
    yc = F.col(y).cast("double") - F.lit(cy)
    # Rows behind the last cut get a chunk that the join with the sizes drops. A filter or a
    # null chunk would be pushed below the digest's projection and compute it at every cut.
    tagged = ranked.select(chunk.alias("chunk"), "_split", xc.alias("xc"), yc.alias("yc"))
    sums = tagged.groupBy("chunk").agg(*[
        F.sum(F.when(F.col("_split") == s, e)).alias(f"{s}_{name}")
        for s in ("train", "test")
        for name, e in (("n", F.lit(1.0)), ("sx", F.col("xc")), ("sy", F.col("yc")),
                        ("sxx", F.col("xc") * F.col("xc")),
                        ("sxy", F.col("xc") * F.col("yc")),
                        ("syy", F.col("yc") * F.col("yc")))])
    # Sizes of all chunks (R4's rule on the counted rows); chunks without new rows
    # still appear.
    sizes = df.sparkSession.range(chunks).select(
        F.col("id").alias("chunk"),
        (F.lit(min_size) + (F.col("id") + 1) * F.lit(step_n)).cast("long").alias("size"))
    stat_cols = [c for c in sums.columns if c != "chunk"]
    # ``chunks`` rows only: a window without partitioning is cheap here.
    upto = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = sizes.join(sums, "chunk", "left").select(
        "chunk", "size",
        *[F.sum(F.coalesce(F.col(c), F.lit(0.0))).over(upto).alias(c) for c in stat_cols])

    def c(name):
        return F.col(name)

    mean_x = F.try_divide(c("train_sx"), c("train_n"))
    mean_y = F.try_divide(c("train_sy"), c("train_n"))
    sxx = c("train_sxx") - c("train_sx") * mean_x
    sxy = c("train_sxy") - c("train_sx") * mean_y
    b = F.try_divide(sxy, sxx)
    a = mean_y - b * mean_x
    sse = (c("test_syy") - F.lit(2.0) * a * c("test_sy") - F.lit(2.0) * b * c("test_sxy")
           + c("test_n") * a * a + F.lit(2.0) * a * b * c("test_sx") + b * b * c("test_sxx"))
    return cum.select(
        "chunk", "size",
        c("train_n").cast("long").alias("n_train"),
        c("test_n").cast("long").alias("n_test"),
        b.alias("slope"),
        (a + F.lit(cy) - b * F.lit(cx)).alias("intercept"),
        F.sqrt(F.try_divide(F.greatest(sse, F.lit(0.0)), c("test_n"))).alias("rmse"),
    )
