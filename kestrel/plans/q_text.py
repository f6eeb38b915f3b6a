"""Text and term-weighting queries (S6, T1-T8, V1-V4) over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import tables as T
from kestrel.functions import porter_sql
from kestrel.functions import text as X
from kestrel.functions.stopwords import ENGLISH_STOP_WORDS, sql_list_literal
from kestrel.operators import features as V
from kestrel.operators.sampling import random_split, split_threshold
from kestrel.plans.catalog import register

SPLIT_SEED = 0

TOKENS_SQL = ("list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z ]', '', 'g'), ' +'), "
              "lambda x: x <> '')")
DOC_TOKENS_SQL = f"(SELECT doc_id, {TOKENS_SQL} AS tokens FROM documents)"
STOP_SQL = sql_list_literal(ENGLISH_STOP_WORDS)


def doc_tokens(spark, sf_dir):
    """(doc_id, tokens) after T1-T3."""
    return T.documents(spark, sf_dir).select(
        "doc_id", X.letter_tokens("text").alias("tokens"))


@register("text_lower", "SELECT doc_id, lower(text) AS text FROM documents")
def text_lower(spark, sf_dir):
    return T.documents(spark, sf_dir).select("doc_id", X.text_lower("text").alias("text"))


@register("keep_letters", """
SELECT doc_id, regexp_replace(lower(text), '[^a-z ]', '', 'g') AS text FROM documents""")
def keep_letters(spark, sf_dir):
    return T.documents(spark, sf_dir).select("doc_id", X.keep_letters("text").alias("text"))


@register("tokenize", f"""
SELECT doc_id, len(tokens) AS n_tokens, len(list_distinct(tokens)) AS n_distinct
FROM {DOC_TOKENS_SQL} t""")
def tokenize(spark, sf_dir):
    t = doc_tokens(spark, sf_dir)
    return t.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"))


@register("join_tokens", f"SELECT doc_id, array_to_string(tokens, ' ') AS text FROM {DOC_TOKENS_SQL} t")
def join_tokens(spark, sf_dir):
    return doc_tokens(spark, sf_dir).select("doc_id", X.join_tokens("tokens").alias("text"))


@register("remove_stopwords", f"""
SELECT doc_id, len(kept) AS n_kept, array_to_string(kept, ' ') AS text FROM (
  SELECT doc_id, list_filter(tokens, lambda x: NOT list_contains({STOP_SQL}, x)) AS kept
  FROM {DOC_TOKENS_SQL} t) k""")
def remove_stopwords(spark, sf_dir):
    """T5 on unstemmed tokens (the stemmed variant runs inside clean_text)."""
    k = doc_tokens(spark, sf_dir).select("doc_id", X.remove_stopwords("tokens").alias("kept"))
    return k.select("doc_id", F.size("kept").cast("long").alias("n_kept"),
                    X.join_tokens("kept").alias("text"))


@register("stopword_table", f"""
SELECT doc_id, len(list_filter(tokens, lambda x: list_contains({STOP_SQL}, x))) AS n_stopwords
FROM {DOC_TOKENS_SQL} t""")
def stopword_table(spark, sf_dir):
    """The stop-word list as data, counted against every document."""
    t = doc_tokens(spark, sf_dir)
    return t.select("doc_id", F.size(F.filter("tokens", lambda x: X.is_stopword(x)))
                    .cast("long").alias("n_stopwords"))


_WORDS_SQL = f"SELECT DISTINCT unnest(tokens) AS word FROM {DOC_TOKENS_SQL} t"
_STEM_SQL = porter_sql.stems("s", porter_sql.DUCKDB)


@register("stem_vocabulary", f"SELECT word, {_STEM_SQL}[1] AS stem FROM (SELECT word, [word] AS s FROM ({_WORDS_SQL}) w) v")
def stem_vocabulary(spark, sf_dir):
    """T4: (word, stem) once per distinct word of the corpus."""
    toks = V.explode_terms(doc_tokens(spark, sf_dir), "doc_id", "tokens") \
            .select(F.col("term").alias("token"))
    return X.stem_vocabulary(toks, "token", 1)


@register("double_stem", f"""
SELECT word, {_STEM_SQL}[1] AS stem
FROM (SELECT word, {_STEM_SQL} AS s FROM (SELECT word, [word] AS s FROM ({_WORDS_SQL}) w) v) t""")
def double_stem(spark, sf_dir):
    """The pandas vectoriser stems the already stemmed text again."""
    toks = V.explode_terms(doc_tokens(spark, sf_dir), "doc_id", "tokens") \
            .select(F.col("term").alias("token"))
    return X.stem_vocabulary(toks, "token", 2)


@register("clean_text", f"""
SELECT doc_id, CAST(len(kept) AS INTEGER) AS n_tokens, array_to_string(kept, ' ') AS text FROM (
  SELECT doc_id, list_filter({_STEM_SQL}, lambda x: NOT list_contains({STOP_SQL}, x)) AS kept
  FROM (SELECT doc_id, tokens AS s FROM {DOC_TOKENS_SQL} t) d) k""")
def clean_text(spark, sf_dir):
    """Lower -> letters -> split -> stem -> stop words -> one string per document."""
    c = X.clean_text(T.documents(spark, sf_dir).select("doc_id", "text"))
    return c.select("doc_id", F.size("clean_tokens").alias("n_tokens"),
                    X.join_tokens("clean_tokens").alias("text"))


_M32 = "4294967295"


def _times_sql(a: str, b: int) -> str:
    return f"((({a}) * {b & 0xFFFF} + ((({a}) * {b >> 16}) & 65535) * 65536) & {_M32})"


def _turned_sql(a: str, by: int) -> str:
    return f"(((({a}) * {1 << by}) & {_M32}) | (({a}) >> {32 - by}))"


# Murmur3 step by step, every intermediate value a column of its own: the bytes of a term
# as a list of numbers, whole words of four, the rest, the final mix.
_MIX_SQL = _times_sql("k2", 0x1B873593)
MURMUR_SQL = f"""(
SELECT term, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END & 262143 AS bucket FROM (
SELECT term, xor(h, h >> 16) AS h FROM (
SELECT term, {_times_sql("h", 0xC2B2AE35)} AS h FROM (
SELECT term, xor(h, h >> 13) AS h FROM (
SELECT term, {_times_sql("h", 0x85EBCA6B)} AS h FROM (
SELECT term, xor(h, h >> 16) AS h FROM (
SELECT term, xor(xor(list_reduce(list_prepend(42::BIGINT, list_transform(ks, lambda k2: {_MIX_SQL})),
         lambda h, k: (({_turned_sql("xor(h, k)", 13)}) * 5 + {0xE6546B64}) & {_M32}), {_times_sql("rest2", 0x1B873593)}), n) AS h FROM (
SELECT term, n, {_turned_sql("rest1", 15)} AS rest2, list_transform(ks1, lambda k1: {_turned_sql("k1", 15)}) AS ks FROM (
SELECT term, n, {_times_sql("rest", 0xCC9E2D51)} AS rest1, list_transform(ks, lambda k: {_times_sql("k", 0xCC9E2D51)}) AS ks1 FROM (
SELECT term, len(b) AS n,
       list_transform(range(len(b) // 4), lambda i: b[4*i+1] + b[4*i+2] * 256 + b[4*i+3] * 65536 + b[4*i+4] * 16777216) AS ks,
       coalesce(b[len(b) // 4 * 4 + 1], 0) + coalesce(b[len(b) // 4 * 4 + 2], 0) * 256
       + coalesce(b[len(b) // 4 * 4 + 3], 0) * 65536 AS rest FROM (
SELECT term, list_transform(regexp_extract_all(hex(encode(term)), '..'), lambda x: ('0x' || x)::BIGINT) AS b
FROM (SELECT DISTINCT unnest(tokens) AS term FROM {DOC_TOKENS_SQL} t))))))))))))"""


@register("hashing_tf", f"""
WITH h AS {MURMUR_SQL},
tf AS (SELECT doc_id, bucket, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM {DOC_TOKENS_SQL} t) u
       JOIN h USING (term) GROUP BY doc_id, bucket),
df AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket)
SELECT doc_id, bucket, tf, tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) AS weight FROM tf JOIN df USING (bucket)""")
def hashing_tf(spark, sf_dir):
    """V1 + V2 in long form: hashed term counts (2^18 buckets) weighted by the fitted IDF."""
    return V.hashed_weights(doc_tokens(spark, sf_dir))


@register("idf_weights", f"""
SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
FROM (SELECT DISTINCT doc_id, unnest(tokens) AS term FROM {DOC_TOKENS_SQL} t) u GROUP BY term""")
def idf_weights(spark, sf_dir):
    """V2 in long form: ln((m + 1) / (df + 1))."""
    return V.idf_weights(doc_tokens(spark, sf_dir))


_TFIDF_SQL = """
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM {docs} t) u
            GROUP BY doc_id, term),
fit_tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM {fit} t) u
            GROUP BY doc_id, term),
m AS (SELECT count(*) AS m FROM {fit} t),
df AS (SELECT term, count(*) AS df FROM fit_tf GROUP BY term),
w AS (SELECT tf.doc_id, tf.term, tf.tf, df.df, tf.tf * (ln((1.0 + m.m) / (1.0 + df.df)) + 1.0) AS raw
      FROM tf JOIN df ON tf.term = df.term, m)
SELECT doc_id, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS tfidf FROM w"""

_TRAIN_DOCS_SQL = f"""(SELECT * FROM {DOC_TOKENS_SQL} d
   WHERE substr(md5('{SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)), 1, 4) < '{split_threshold(0.8)}')"""


@register("tfidf_smooth_l2", _TFIDF_SQL.format(docs=DOC_TOKENS_SQL, fit=DOC_TOKENS_SQL))
def tfidf_smooth_l2(spark, sf_dir):
    """V3: the pandas half's vectoriser, in long form."""
    return V.tfidf_smooth_l2(doc_tokens(spark, sf_dir))


@register("tfidf_scope", _TFIDF_SQL.format(docs=DOC_TOKENS_SQL, fit=_TRAIN_DOCS_SQL))
def tfidf_scope(spark, sf_dir):
    """V4: weights fitted on the train split only, applied to every document."""
    docs = doc_tokens(spark, sf_dir)
    train = random_split(docs, "doc_id", 0.8, SPLIT_SEED).where(F.col("split") == "train") \
        .drop("split")
    return V.tfidf_smooth_l2(docs, fit_docs=train)
