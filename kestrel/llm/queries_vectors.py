"""Approximate nearest neighbours (operator 12): the query over all embeddings.

The SQL twin is the exact answer. The query equals it where every shard has at most
``vector_search.LEAST`` rows; on larger tables its recall is measured in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import vector_search
from kestrel.llm.catalog import register
from kestrel.llm.common import table

OP12_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT * FROM v WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                        AND len(list_filter(x, lambda c: c <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, u.vec_id, sqrt(list_sum(list_transform(list_zip(q.x, u.x),
                 lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS score
      FROM u q JOIN u ON q.vec_id <> u.vec_id AND len(q.x) = len(u.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@register("op12_cross_polytope", OP12_SQL)
def op12_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_search.search(vectors, vectors.where(vector_search.is_query()), k=10)
