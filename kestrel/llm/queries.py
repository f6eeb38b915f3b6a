"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (
    exact_dedup, html_layout, mixing, near_dedup, quality, secret_scan, sharding, topk_search,
    unigram, warc_fixity)
from kestrel.llm.catalog import register
from kestrel.llm.common import table

#: Vocabulary files are read from where they are installed, by the driver.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@register("op2_secret_worklist")
def op2_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text and in everything that decodes from it."""
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@register("op4_sentencepiece_unigram")
def op4_sentencepiece_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether they decode to it."""
    return unigram.encode_documents(table(spark, sf_dir, "documents"), PIECES)


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""


@register("op3_exact_dedup", OP3_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts by distributed MSD radix partitioning; every row with its group."""
    return exact_dedup.equal_text_groups(table(spark, sf_dir, "documents"))


def _digest52_sql(key: str) -> str:
    return f"CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT)"


def _draw_sql(name: str, weight: float) -> str:
    return f"-ln(({_digest52_sql(f"'{name}:' || key")} + 0.5) / 4503599627370496.0) / {weight}"


def _descend_sql(node: dict) -> str:
    """The same choice as nested CASE: the first child whose draw is not above the others."""
    kids = [(str(c), n if isinstance(n, float) else sharding._weight(n),
             str(c) if isinstance(n, float) else _descend_sql(n)) for c, n in node.items()]
    if len(kids) == 1:
        return kids[0][2]
    draws = [_draw_sql(c, w) for c, w, _ in kids]
    least = f"least({', '.join(draws)})"
    whens = " ".join(f"WHEN {d} = {least} THEN {k[2]}" for d, k in zip(draws, kids))
    return f"(CASE {whens} END)"


# CRC-32 (the reflected polynomial 0xEDB88320), byte by byte with a table made by rule.
OP6_SQL = f"""
WITH bits AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(b))),
d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key,
             coalesce(strlen(text), 0) + 1 AS size FROM documents),
s AS (SELECT d.*, {_descend_sql(sharding.tree(8))} AS shard,
             {_descend_sql(sharding.tree(9))} AS grown_shard,
             {_digest52_sql("'slot:' || key")} AS h,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                   regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)),
                 lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
      FROM d, bits)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id, size, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM s
"""


@register("op6_hash_tree_sharding", OP6_SQL)
def op6_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards of a region/rack/shard tree (law: key)."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 8)


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         {_digest52_sql("'mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')")} AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS no FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][no % 3 + 1]::DOUBLE AS w, [-0.5, 0.0, 0.5][no % 3 + 1]::DOUBLE AS tilt,
             source_size * 2.0::DOUBLE AS cap FROM n),
l AS (SELECT *, cap / w AS ratio, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, tilt, least(cap, w * (SELECT arg_min(level, (ratio, no)) FROM l
             WHERE level <= ratio)) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.tilt,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS word0
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, greatest(0, least(size, round(target)::BIGINT - word0))::BIGINT AS take_1,
             greatest(0, least(size, round(target)::BIGINT - word0 - source_size))::BIGINT AS take_2 FROM r)
SELECT doc_id, size, source_size, target, CAST(take_1 + take_2 AS BIGINT) AS taken, take_1, take_2,
       CASE WHEN take_1 > 0 THEN 2 * (word0 / target)
            / (1 - tilt + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * (word0 / target))) END AS position_1,
       CASE WHEN take_2 > 0 THEN 2 * ((word0 + source_size) / target)
            / (1 - tilt + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * ((word0 + source_size) / target))) END AS position_2
FROM p
"""


@register("op7_curriculum_mixing", OP7_SQL)
def op7_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their words in the mix, range-sorted by training position."""
    d = mixing.allocate(table(spark, sf_dir, "documents"))
    return d.orderBy(F.col("position_1").asc_nulls_last(), "doc_id")


@register("op8_latent_neighbours")
def op8_latent_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by votes of similar labelled ones."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_dart_minhash")
def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS words
           FROM documents),
n AS (SELECT count(*) AS n_docs, sum(len(words)) / count(*) AS average FROM d),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, ln(1 + (n_docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, n GROUP BY term, n_docs),
s AS (SELECT q.doc_id AS query_id, p.doc_id,
             round(sum(q.tf * f.idf * (p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * len(d.words) / n.average)))), 6) AS score
      FROM p AS q JOIN f USING (term) JOIN p USING (term) JOIN d ON d.doc_id = p.doc_id, n
      WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, p.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@register("op1_block_max_wand", OP1_SQL)
def op1_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents by BM25 for every document whose id is divisible by 100."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return topk_search.search(docs, docs.where(topk_search.is_query()), k=10)


@register("op5_layout_extraction")
def op5_layout_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page, laid out."""
    return html_layout.extract_pages(table(spark, sf_dir, "pages"))


def _warc_sql() -> str:
    record = ("'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:uuid:' || "
              "concat_ws('-', substr(m, 1, 8), substr(m, 9, 4), substr(m, 13, 4), substr(m, 17, 4), substr(m, 21, 12))"
              f" || '>' || nl || 'WARC-Date: {warc_fixity.DATE}' || nl || 'WARC-Target-URI: ' || coalesce(url, '')"
              " || nl || 'Content-Type: text/html' || nl || 'Content-Length: ' || strlen(body)::VARCHAR"
              " || nl || nl || body || nl || nl")
    levels = "".join(f""",
n{i} AS (SELECT warc_file, {'0' if i > warc_fixity.LEVELS else f'node // {warc_fixity.FANOUT}'} AS node,
        sha256(string_agg(node::VARCHAR || ':' || digest, chr(10) ORDER BY node)) AS digest FROM n{i - 1} GROUP BY ALL)"""
                     for i in range(2, warc_fixity.LEVELS + 2))
    return f"""
WITH b AS (SELECT page_id, url, coalesce(html, '') AS body, chr(13) || chr(10) AS nl,
                  coalesce(CAST(page_id AS VARCHAR), 'null') AS key FROM pages),
m AS (SELECT *, md5('warc:' || key) AS m FROM b),
r AS (SELECT page_id, key, {record} AS record FROM m),
f AS (SELECT page_id, key, strlen(record) AS length, sha256(record) AS digest,
             {_digest52_sql("'fate:' || key")} % 500 AS fate FROM r),
t AS (SELECT greatest(1, ceil(sum(length) / {float(warc_fixity.FILE_BYTES)}))::BIGINT AS files FROM f),
w AS (SELECT f.*, ({_digest52_sql("'file:' || key")} % files)::INTEGER AS warc_file,
             {_digest52_sql("'place:' || key")} AS h FROM f, t),
l AS (SELECT *, (sum(length) OVER (PARTITION BY warc_file ORDER BY h, page_id, length, digest
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - length AS start FROM w),
n1 AS (SELECT warc_file, start // {warc_fixity.RANGE_BYTES} AS node,
              sha256(string_agg(concat_ws(':', start, length, digest), chr(10) ORDER BY start)) AS digest
       FROM l GROUP BY ALL){levels}
SELECT page_id, l.warc_file, start AS "offset", length, l.digest, n{warc_fixity.LEVELS + 1}.digest AS root,
       CASE fate WHEN 0 THEN 'damaged' WHEN 1 THEN 'missing' ELSE 'ok' END AS status
FROM l JOIN n{warc_fixity.LEVELS + 1} USING (warc_file)
"""


@register("op10_merkle_fixity", _warc_sql())
def op10_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas, and where the second departs."""
    return warc_fixity.fixity_drill(table(spark, sf_dir, "pages"))
