"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At every level each child draws ``-ln(u) / weight`` with ``u`` a hash of (child, key), and
the smallest draw wins, so a child is chosen in proportion to its weight. A draw depends
only on the child's own name and weight: changing a weight moves rows only between that
child and its siblings, and nothing moves inside untouched subtrees. A shard that is added
opens a region of its own, so every older node keeps its weight and the new shard only
takes rows, into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import bucket_count, checkpointed, digest52, key_text, running_sum

BASE_SHARDS, RACK_SHARDS, REGION_RACKS = 8, 2, 2


def tree(shards: int, base: int = BASE_SHARDS, weights: dict[int, float] | None = None) -> dict:
    """{region: {rack: {shard: weight}}}: the first ``base`` shards by two in a rack and
    two racks in a region, every further shard in a region of its own."""
    weights = weights or {}
    out: dict = {}
    for s in range(shards):
        if s < base:
            region, rack = f"g{s // (RACK_SHARDS * REGION_RACKS)}", f"r{s // RACK_SHARDS}"
        else:
            region, rack = f"g+{s}", f"r+{s}"
        out.setdefault(region, {}).setdefault(rack, {})[s] = float(weights.get(s, 1.0))
    return out


def _weight(node) -> float:
    return node if isinstance(node, float) else sum(_weight(c) for c in node.values())


def _draw(name: str, weight: float, key: Column) -> Column:
    u = (digest52(F.concat(F.lit(f"{name}:"), key)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(weight)


def _descend(node: dict, key: Column) -> Column:
    """The shard under ``node`` that the draws lead to, as nested CASE expressions: only
    the draws on the path of a row are evaluated below the first level."""
    children = [(c, w) for c, n in node.items() if (w := _weight(n)) > 0]
    below = {c: F.lit(c) if isinstance(node[c], float) else _descend(node[c], key)
             for c, _ in children}
    if len(children) == 1:
        return below[children[0][0]]
    draws = F.array(*[_draw(str(c), w, key) for c, w in children])
    at = F.array_position(draws, F.array_min(draws))
    out = below[children[-1][0]]
    for i in range(len(children) - 2, -1, -1):
        out = F.when(at == i + 1, below[children[i][0]]).otherwise(out)
    return out


def shard_of(key: Column, topology: dict) -> Column:
    """Shard number of a key (any type; null is a key of its own) in the tree."""
    return _descend(topology, key_text(key)).cast("int")


def assign_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id",
                  text_col: str = "text", weights: dict[int, float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    ``size``: UTF-8 bytes of the text plus 1 (null: 1); ``text_crc32`` of a null text is
    that of the empty one. ``slot`` numbers the rows of a shard from 0 in the order of a
    hash of doc_id, then doc_id, size, checksum; repeated rows get the same shard and
    slots side by side. Rows with a null id share the key ``null``.
    """
    text = F.col(text_col).cast("string")
    placed = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(F.col(id_col), tree(shards, weights=weights)).alias("shard"),
        shard_of(F.col(id_col), tree(shards + 1, weights=weights)).alias("grown_shard"),
        digest52(F.concat(F.lit("slot:"), key_text(id_col))).alias("_h"))
    placed = checkpointed(placed.withColumn("_one", F.lit(1).cast("long")))
    slots = running_sum(placed, "shard", "_h", ["doc_id", "size", "text_crc32"], "_one", "slot",
                        bucket_count(placed.count()))
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        "slot", "grown_shard")
