"""Periodic runs (operator 11): the query over all documents and its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import periodic_runs
from kestrel.llm.catalog import register
from kestrel.llm.common import table


def planted_words(words: str = "words", doc_id: str = "doc_id") -> Column:
    """The words of a document, made periodic from a place on in about a tenth of them (decided
    by the CRC-32 of the id; a document without id stays as it is)."""
    w, n = F.col(words), F.size(words)
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.floor((n - a) / (F.lit(3) + g % 8)) + 1).cast("int")
    back = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i >= a, a + (i - a) % p).otherwise(i)))
    return F.when((h % 10 == 0) & (n > 0), back).otherwise(w)


# CRC-32 byte by byte with a table made by rule (the reflected polynomial 0xEDB88320).
OP11_SQL = r"""
WITH bits AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(b))),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                   regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
                 lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM documents, bits),
e AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d),
f AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
             w[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1]) END AS w FROM e),
u AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM f),
pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM u x JOIN u y
          ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 3 <= x.n),
lags AS (SELECT doc_id, q FROM pairs GROUP BY doc_id, q HAVING count(*) >= greatest(24, 3 * q) - q),
steps AS (SELECT p.doc_id, p.q, p.i, p.i - row_number() OVER (PARTITION BY p.doc_id, p.q ORDER BY p.i) AS island
          FROM pairs p JOIN lags l ON p.doc_id = l.doc_id AND p.q = l.q),
stretches AS (SELECT doc_id, q, min(i) AS s, max(i) + q + 1 AS t FROM steps GROUP BY doc_id, q, island
              HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (SELECT doc_id, s, t, min(q) AS q FROM stretches GROUP BY doc_id, s, t),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', t - s, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
                list({'s': s, 'l': t - s, 'q': q} ORDER BY s, q) AS r FROM runs GROUP BY doc_id),
best AS (SELECT *, list_reduce(r, lambda x, y: CASE WHEN x.l * y.q >= y.l * x.q THEN x ELSE y END) AS b FROM told),
gone AS (SELECT DISTINCT u.doc_id, u.i FROM u JOIN runs ON u.doc_id = runs.doc_id AND u.i >= s + q AND u.i < t),
kept AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS text FROM u LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.i = u.i
         WHERE g.i IS NULL GROUP BY u.doc_id)
SELECT f.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.q::BIGINT AS period,
       (1000 * b.l // b.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM f LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@register("op11_periodic_runs", OP11_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text: their number, the one with the greatest
    exponent, and digests of all of them and of the text without their repeats. A text
    without words has none of both and the digests of the empty string."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.words_of("text").alias("words"))
    found = periodic_runs.find_runs(docs.select("doc_id", planted_words().alias("words")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), periodic_runs.longest_by_exponent().alias("b"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period",
        F.floor(F.col("b.length") * 1000 / F.col("b.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
