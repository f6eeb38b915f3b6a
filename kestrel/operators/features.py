"""Term weighting (V1-V4).

Two shapes: a long form ``(doc_id, term, tf, df, weight)`` that SQL can check, built
from aggregations and equi-joins only, and Spark ML vectors for model fitting.
Per-term statistics are computed with ``groupBy`` (partial aggregation absorbs a term
present in every document) and joined back: frequent terms by a broadcast of bounded
size, the others by a shuffle. A window partitioned by term would put all rows of a
frequent term into one task. Per-document statistics use a window over the
document, a group bounded by the document's own length.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, IDF
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize


def keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def explode_terms(docs: DataFrame, key: str | list[str], tokens: str) -> DataFrame:
    """(key, term) for every token. ``explode_outer`` + a null filter, because for a
    plain ``explode`` Catalyst infers ``size(tokens) > 0`` and pushes it below any
    repartition, evaluating the whole tokenisation a second time inside the scan."""
    return (docs.select(*keys(key), F.explode_outer(tokens).alias("term"))
                .where(F.col("term").isNotNull()))


def has_repeats(docs: DataFrame, *key: str) -> bool:
    """Whether two rows share a key; only the keys are read."""
    return not docs.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def term_counts(docs: DataFrame, key: str | list[str] = "doc_id", tokens: str = "tokens") -> DataFrame:
    """(key, term, tf): occurrences of each term in each document.

    A row's tokens are sorted and the lengths of their runs taken, where the row is; only
    where keys repeat are the counts of several rows summed, in a shuffle."""
    on = keys(key)
    words = docs.select(*on, F.sort_array(F.array_compact(tokens)).alias("_s"))
    at = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    starts = words.where(F.size("_s") > 0).select(*on, "_s", at.alias("_at"))
    runs = F.transform("_at", lambda i, k: F.struct(
        F.get("_s", i).alias("term"), (F.coalesce(F.get("_at", k + 1), F.size("_s")) - i).cast("long").alias("tf")))
    tf = explode_terms(starts.select(*on, runs.alias("_runs")), on, "_runs").select(*on, "term.*")
    return tf.groupBy(*on, "term").agg(F.sum("tf").alias("tf")) if has_repeats(docs, *on) else tf


def document_frequency(tf: DataFrame, key: str = "doc_id") -> DataFrame:
    """(term, df): documents containing each term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


HOT_TERMS = 10_000


def join_term_stats(tf: DataFrame, stats: DataFrame, hot_terms: int = HOT_TERMS) -> DataFrame:
    """``tf`` (.., term, ..) with the statistics (term, df, ..) of its terms.

    Terms in more than 1 / ``hot_terms`` of all postings are joined by broadcast: there are
    at most ``hot_terms`` of them, since their document frequencies sum up to the postings.
    Every other term is in so few documents that its rows fit in a task of the shuffled
    join. There a task holds its share of the statistics, a row a term, and the postings
    stream past it unsorted. ``stats`` is read three times: pass a checkpoint.
    """
    postings = stats.agg(F.sum("df")).first()[0] or 0
    limit = postings / hot_terms
    hot = F.broadcast(stats.where(F.col("df") > limit))
    often = tf.join(hot, "term")
    seldom = tf.join(F.broadcast(stats.where(F.col("df") > limit).select("term")), "term", "left_anti") \
               .join(stats.where(F.col("df") <= limit).hint("shuffle_hash"), "term")
    return often.unionByName(seldom)


def n_documents(docs: DataFrame) -> int:
    """Corpus size; a scalar computed once and used as a literal."""
    return docs.count()


def idf_weights(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens",
                fit_docs: DataFrame | None = None) -> DataFrame:
    """(term, df, idf) with ``idf = ln((m + 1) / (df + 1))`` as Spark ML's IDF (V2).

    ``fit_docs`` chooses the documents the weights are fitted on (V4): the reference
    fits on all rows before its split, which lets test rows shape the weights.
    """
    base = fit_docs if fit_docs is not None else docs
    m = n_documents(base)
    df = document_frequency(term_counts(base, key, tokens), key)
    return df.select("term", "df",
                     F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf_smooth_l2(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens",
                    fit_docs: DataFrame | None = None) -> DataFrame:
    """Exact-vocabulary TF-IDF with smooth idf and L2-normalised rows (V3).

    ``weight = tf * (ln((1 + m) / (1 + df)) + 1) / ||row||``. Terms never seen in the
    fitting documents get no weight, as with a vocabulary fitted there.
    """
    base = fit_docs if fit_docs is not None else docs
    m = n_documents(base)
    tf = materialize(term_counts(docs, key, tokens))  # the texts are tokenised once
    df = document_frequency(term_counts(base, key, tokens) if fit_docs is not None else tf,
                            key)
    idf = materialize(df.select(
        "term", "df", (F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")))
    w = join_term_stats(tf, idf).withColumn("raw", F.col("tf") * F.col("idf"))
    # A document is a bounded group (its own distinct terms), so the row norm is a
    # window over the document; unlike a groupBy + join it does not recompute ``w``.
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return w.select(key, "term", "tf", "df", (F.col("raw") / norm).alias("tfidf"))


def murmur3_bucket(term: str | Column, num_features: int = 1 << 18) -> Column:
    """The bucket of a term in Spark ML's ``HashingTF`` (V1): Murmur3 (32 bits, seed 42) of
    its UTF-8 bytes, modulo the number of features.

    Longs hold all products: a factor is split into halves of 16 bits. The algorithm is the
    published one; its constants stand below."""
    c = F.col(term) if isinstance(term, str) else term
    raw, n = c.cast("binary"), F.octet_length(c)
    ones = (1 << 32) - 1

    def named(x: Column, use) -> Column:
        """``use`` of a value that is computed once, however often it is named."""
        return F.element_at(F.transform(F.array(x), use), 1)

    def times(a: Column, b: int) -> Column:
        return named(a, lambda x: (x * (b & 0xFFFF) + ((x * (b >> 16)).bitwiseAND(0xFFFF)) * 65536).bitwiseAND(ones))

    def turned(a: Column, by: int) -> Column:
        return named(a, lambda x: (x * (1 << by)).bitwiseAND(ones).bitwiseOR(F.shiftrightunsigned(x, 32 - by)))

    def byte(at: Column) -> Column:
        return F.conv(F.hex(raw.substr(at, F.lit(1))), 16, 10).cast("long")

    def mixed(k: Column) -> Column:
        return times(turned(times(k, 0xCC9E2D51), 15), 0x1B873593)

    words = F.floor(n / 4).cast("int")

    def step(h: Column, i: Column) -> Column:
        at = i * 4 + 1
        k = byte(at) + byte(at + 1) * (1 << 8) + byte(at + 2) * (1 << 16) + byte(at + 3) * (1 << 24)
        return (turned(h.bitwiseXOR(mixed(k)), 13) * 5 + 0xE6546B64).bitwiseAND(ones)

    blocks = F.when(words > 0, F.sequence(F.lit(0), words - 1)).otherwise(F.array().cast("array<int>"))
    h = F.aggregate(blocks, F.lit(42).cast("long"), step)
    rest = F.aggregate(F.sequence(F.lit(0), F.lit(2)), F.lit(0).cast("long"), lambda k, i: k + F.when(
        words * 4 + i < n, byte(words * 4 + i + 1) * F.pow(F.lit(256.0), i).cast("long")).otherwise(0))
    h = h.bitwiseXOR(mixed(rest)).bitwiseXOR(n.cast("long"))
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = times(named(h, lambda x: x.bitwiseXOR(F.shiftrightunsigned(x, shift))), factor)
    signed = named(h, lambda x: F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x))
    return F.pmod(signed, F.lit(num_features).cast("long")).cast("int")


def hashed_vectors(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens",
                   num_features: int = 1 << 18) -> DataFrame:
    """(key, tf_features): Spark ML's ``HashingTF`` (V1) of every row; null tokens are none."""
    words = docs.select(key, F.coalesce(F.array_compact(tokens), F.array().cast("array<string>")).alias("_tokens"))
    return HashingTF(inputCol="_tokens", outputCol="tf_features", numFeatures=num_features) \
        .transform(words).select(key, "tf_features")


def vector_entries(vector: str, index: str, value: str, kind: str) -> Column:
    """The array of (index, value) of a sparse vector's entries."""
    v = F.unwrap_udt(vector)
    return F.arrays_zip(v["indices"].alias(index), v["values"].alias(value)).cast(kind)


def hashed_counts(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens",
                  num_features: int = 1 << 18) -> DataFrame:
    """(key, bucket, tf): V1 in long form, zeros left out, counted where the row is; only where
    keys repeat are the counts of several rows summed, in a shuffle."""
    entries = hashed_vectors(docs, key, tokens, num_features) \
        .select(key, vector_entries("tf_features", "bucket", "tf", "array<struct<bucket:int,tf:bigint>>").alias("_e"))
    tf = entries.select(key, F.explode_outer("_e").alias("_e")).where("_e is not null").select(key, "_e.*")
    return tf.groupBy(key, "bucket").agg(F.sum("tf").alias("tf")) if has_repeats(docs, key) else tf


def hashed_weights(docs: DataFrame, key: str = "doc_id", tokens: str = "tokens",
                   num_features: int = 1 << 18) -> DataFrame:
    """(key, bucket, tf, weight): V1 weighted by V2, tf * ln((m + 1) / (df + 1)) with the
    documents df of the bucket among all m. There are at most ``num_features`` buckets: up to
    2^18 of them are broadcast."""
    m = n_documents(docs)
    counts = materialize(hashed_counts(docs, key, tokens, num_features)).withColumnRenamed("bucket", "term")
    df = materialize(document_frequency(counts, key))
    found = counts.join(F.broadcast(df), "term") if num_features <= 1 << 18 else join_term_stats(counts, df)
    return found.select(
        key, F.col("term").alias("bucket"), "tf",
        (F.col("tf") * F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0))).alias("weight"))


def hashed_tfidf(docs: DataFrame, tokens: str = "tokens", num_features: int = 1 << 18,
                 fit_docs: DataFrame | None = None, tf_col: str = "tf_features",
                 out: str = "features") -> DataFrame:
    """HashingTF (V1) then IDF (V2) as Spark ML vectors, for the classifiers.

    IDF is fitted on ``fit_docs`` (default: all of ``docs``, as the reference).
    """
    htf = HashingTF(inputCol=tokens, outputCol=tf_col, numFeatures=num_features)
    words = F.coalesce(tokens, F.array().cast("array<string>"))  # null tokens are none
    tf = htf.transform(docs.withColumn(tokens, words))
    fit_on = htf.transform(fit_docs.withColumn(tokens, words)) if fit_docs is not None else tf
    model = IDF(inputCol=tf_col, outputCol=out).fit(fit_on)
    return model.transform(tf)
