"""Ranked lexical search (operator 13): every benchmark item against all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import lexical_search
from kestrel.llm.catalog import register
from kestrel.llm.common import table

OP13_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS tf FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark) GROUP BY item_id, term),
s AS (SELECT item_id, t.doc_id, sum(q.tf * w * ((1000000000 * t.tf) //
             (1000 * t.tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN t USING (term) JOIN n ON n.doc_id = t.doc_id, c GROUP BY item_id, t.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@register("op13_max_sketches", OP13_SQL)
def op13_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark"), k=10)
