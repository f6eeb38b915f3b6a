"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions.

Training time runs from 0 to 1. Source s has the weight schedule
``target_s * (1 + tilt_s * (2 t - 1))``: its integral over [0, 1] is the source's target,
and its integral up to t, ``target_s * (t + tilt_s * (t^2 - t))``, is the demand for its
words so far. A document that begins at word c of its source's stream is due when the
demand reaches c, so its training position is the inverse of that integral at c. The
stream of a source is its documents in hash order, passed over once or twice; the mix is
the range-sort of all passes by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import bucket_count, checkpointed, digest52, key_text, running_sum

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
TILTS = (-0.5, 0.0, 0.5)
SHARE = 1.5     # words of the mix, as a share of all words
REPEATS = 2     # no source is repeated more often


def source_targets(sizes: DataFrame, weights=WEIGHTS, tilts=TILTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """source, source_no, source_size, target, tilt: one row per source.

    ``sizes`` has (source, source_size), one row per source. Targets share ``share`` of
    all words by weight; none exceeds ``repeats`` times its source, and what is above goes
    to the others by weight. That is the level L with sum(min(cap, weight * L)) = total:
    with the sources in the order of cap / weight, the first whose level
    (total - caps before) / (weights from here on) is not above its own ratio.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    pick = lambda values: F.element_at(
        F.array(*[F.lit(float(v)) for v in values]),
        (F.col("source_no") % len(values) + 1).cast("int"))
    d = sizes.withColumn("source_no", F.row_number().over(by_name) - 1) \
             .withColumn("_w", pick(weights)).withColumn("tilt", pick(tilts)) \
             .withColumn("_cap", F.col("source_size") * F.lit(float(repeats))) \
             .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    by_ratio = Window.orderBy("_ratio", "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    d = d.withColumn("_total", F.sum("source_size").over(everything) * F.lit(share)) \
         .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / F.sum("_w").over(onward))
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "source_no", "_level")))
    d = d.withColumn("_at", first.over(everything))
    # All targets at their caps only when share >= repeats: no level is in reach then.
    target = F.coalesce(F.least(F.col("_cap"), F.col("_w") * F.col("_at._level")), F.col("_cap"))
    return d.select("source", "source_no", "source_size", target.alias("target"), "tilt")


def _position(word: Column) -> Column:
    """Time at which the demand for a source's words reaches ``word``."""
    u = word / F.col("target")
    b = F.lit(1.0) - F.col("tilt")
    return 2 * u / (b + F.sqrt(b * b + 4 * F.col("tilt") * u))


def allocate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", carry: bool = False, **options) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, take_1, take_2,
    position_1, position_2 (null where that pass takes nothing); with ``carry`` the whole
    row as ``row``.

    ``size`` counts the words of the text (null: 0). Whole documents are taken, but for
    the one at which a source's target is reached: its first words only, so that every
    source gives its target, rounded to whole words. The order in a source follows a hash
    of doc_id, then doc_id, size and a hash of the text, so reruns agree. Null is a source
    of its own, the last one. Empty texts take nothing; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        digest52(F.concat(F.lit("mix:"), key_text(id_col))).alias("_h"),
        F.xxhash64(text).alias("_tie"), *columns)
    sized = checkpointed(rows.drop("row"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(sizes, **options)).withColumnRenamed("source", "_s")

    def with_target(d: DataFrame) -> DataFrame:
        """One row per source is joined; Spark broadcasts it only while it is small."""
        return d.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    # The text travels once, with its row, and only if the caller wants the rows.
    d = running_sum(with_target(rows if carry else sized), "source_no", "_h",
                    ["doc_id", "size", "_tie"], "size", "_start", bucket_count(sized.count()),
                    totals_of=with_target(sized))
    words = F.round("target").cast("long")

    def take(n: int) -> Column:
        start = F.col("_start") + n * F.col("source_size")
        return F.greatest(F.lit(0), F.least(F.col("size"), words - start)).cast("long")

    d = d.withColumn("take_1", take(0)).withColumn("take_2", take(1))
    due = lambda n: F.when(
        F.col(f"take_{n + 1}") > 0, _position(F.col("_start") + n * F.col("source_size")))
    return d.select("doc_id", "size", "source_size", "target",
                    (F.col("take_1") + F.col("take_2")).alias("taken"), "take_1", "take_2",
                    due(0).alias("position_1"), due(1).alias("position_2"),
                    *(["row"] if carry else []))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, spacing kept."""
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def training_order(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, range-sorted by
    training position. A document of which only the first words are taken is cut there."""
    d = allocate(docs, text_col=text_col, carry=True, **options)
    passes = F.filter(F.array(F.struct(F.col("position_1").alias("position"), F.col("take_1").alias("take")),
                              F.struct(F.col("position_2").alias("position"), F.col("take_2").alias("take"))),
                      lambda p: p["take"] > 0)
    d = d.select("doc_id", "size", "row", F.explode(passes).alias("p"))
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    cut = F.when(F.col("p.take") < F.col("size"), first_words(text, F.col("p.take"))).otherwise(text)
    d = d.orderBy("p.position", "doc_id")
    return d.select(*[cut.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
