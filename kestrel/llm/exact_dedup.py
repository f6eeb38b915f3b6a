"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by successive byte ranges of their text: round 1 deals them by the
first bytes, round 2 deals every surviving group by the next bytes, and so on, until a
group is a single row or its texts have ended. Two texts are equal when they were never
separated, so equality needs no digest. The ranges grow sixteenfold, so the number of
rounds is logarithmic in the longest text that has a copy, and a row carries only the
bytes that are still to be compared.

Skew: a group is never gathered. Counting pre-aggregates (group, bytes) before the
shuffle, and rows meet the counts over ``salts`` copies of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kestrel.llm.common import checkpointed, drop_rows

FIRST_BYTES = 256
GROWTH = 16
WIDEST = 1 << 28  # bytes of one round; wider literals would leave the range of an int
SALTS = 16


def _split(rows: DataFrame, width: int, salts: int, tie: list[str]):
    """Deal the rows of every group by their next ``width`` bytes.

    Returns the rows without these bytes, with ``next`` (id of the group they stay in;
    null when alone), ``size``, ``best`` and ``more`` (the text goes on); and the groups."""
    rest = F.col("rest")
    keyed = rows.select(*[c for c in rows.columns if c != "rest"],
                        F.substring(rest, 1, width).alias("chunk"),
                        (F.octet_length(rest) > width).alias("more"),
                        F.pmod(F.xxhash64(*tie), F.lit(salts)).cast("int").alias("salt"),
                        F.substring(rest, width + 1, 2**31 - 1 - width).alias("rest"))
    groups = keyed.groupBy("gid", "chunk", "more") \
                  .agg(F.count(F.lit(1)).alias("size"), F.max(F.struct(*tie)).alias("best")) \
                  .where("size > 1") \
                  .withColumn("next", F.monotonically_increasing_id())
    groups = checkpointed(groups)  # fixes the ids in ``next``
    spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return keyed.join(spread, ["gid", "chunk", "more", "salt"], "left") \
                .drop("chunk", "salt", "gid"), groups


def equal_text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      first_bytes: int = FIRST_BYTES, growth: int = GROWTH,
                      salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical byte for byte; null counts as empty, so null and empty
    texts are one group. The largest doc_id of a group stays (a null id is smallest). When
    rows repeat with the same id and text, exactly one of them is kept. Empty tables give
    no rows; other columns don't matter and may have any names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("gid"),
                       F.sha2(text, 256).alias("sha"), text.cast("binary").alias("rest"))
    best_type = StructType([StructField("doc_id", rows.schema["doc_id"].dataType),
                            StructField("uid", LongType())])

    def state_of(joined: DataFrame, uid, open_, size, best) -> DataFrame:
        """One row per document that was still open; the bytes only of those that go on."""
        return checkpointed(joined.select(
            "doc_id", uid.alias("uid"), open_.alias("open"), "next", size.alias("size"),
            best.cast(best_type).alias("best"), "sha", F.when(open_, F.col("rest")).alias("rest")))

    def closed(d: DataFrame) -> DataFrame:
        """Rows whose group is decided: alone, or their texts have ended."""
        alone = F.col("next").isNull()
        return d.where("not open").select(
            "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            (alone | F.col("best").eqNullSafe(F.struct("doc_id", "uid"))).alias("kept"),
            F.col("sha").alias("text_sha256"))

    # Every group of round 1 goes on to round 2, where each row has an id of its own (fixed
    # by the checkpoint) that breaks ties between repeated rows.
    width = first_bytes
    joined, groups = _split(rows, width, salts, ["doc_id"])
    none = F.lit(None)
    state = state_of(joined, F.monotonically_increasing_id(), F.col("next").isNotNull(),
                     none.cast("long"), none)
    done = [closed(state)]
    going = not groups.isEmpty()
    while going:
        width = min(width * growth, max(width, WIDEST))
        rows = state.where("open").select("doc_id", "uid", "sha", "rest", F.col("next").alias("gid"))
        joined, groups = _split(rows, width, salts, ["doc_id", "uid"])
        state = state_of(joined, F.col("uid"), F.col("next").isNotNull() & F.col("more"),
                         F.col("size"), F.col("best"))
        done.append(closed(state))
        going = not groups.where("more").isEmpty()
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def drop_equal_texts(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    groups = equal_text_groups(docs, **options)
    return drop_rows(docs, groups.select(
        "doc_id", F.unhex(F.substring("text_sha256", 1, 32)).alias("digest"), "kept"))
