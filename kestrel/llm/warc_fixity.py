"""WARC records and a Merkle fixity audit of their replicas.

Pages become WARC/1.1 records that are laid out one after another in files. Every record
is hashed; the hashes of the records that begin in a range of 64 KiB, in the order of
their offsets, are hashed into a node; ranges grow sixteenfold from level to level up to
the root of a file. An audit compares the roots of two replicas and descends only into
branches that differ, level by level, until it stands at the records: damaged, missing or
not in the primary. Nodes gather at most the records that begin in 64 KiB, or 16 nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import bucket_count, checkpointed, digest52, key_text, running_sum
from kestrel.session import remove_tree as remove_scratch, scratch_path

FILE_BYTES = 16 << 20      # a file's records have about so many bytes
RANGE_BYTES = 64 << 10     # a lowest node covers records that begin in so many bytes
FANOUT = 16
PARTS = 4                  # Parquet files of a WARC file
LEVELS = 4                 # 64 KiB, 1 MiB, 16 MiB, 256 MiB; the root is above
DATE = "1970-01-01T00:00:00Z"


def record_text(page_id: str = "page_id", url: str = "url", html: str = "html") -> Column:
    """A WARC resource record. Its id is made from the page's; null urls and pages are empty."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit("warc:"), key_text(page_id)))
    uuid = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid,
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.coalesce(F.col(url).cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _files(total: int | None, file_bytes: int) -> int:
    return max(1, -(-int(total or 0) // file_bytes))


def _file_of(files: int) -> Column:
    return F.pmod(digest52(F.concat(F.lit("file:"), key_text("page_id"))), F.lit(files)).cast("int")


def lay_out(records: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Give every record its place: adds ``warc_file`` and ``offset`` to rows that have
    page_id, length and any narrow columns. A page's file follows from a hash of its id;
    in a file the records stand in the order of another hash, then page_id and length."""
    narrow = checkpointed(records.withColumn("_h", digest52(F.concat(F.lit("place:"), key_text("page_id")))))
    total = narrow.agg(F.sum("length")).first()[0] or 0
    placed = checkpointed(narrow.withColumn("warc_file", _file_of(_files(total, file_bytes))))
    return checkpointed(running_sum(placed, "warc_file", "_h", ["page_id", "length", "digest"],
                                    "length", "offset", bucket_count(placed.count())).drop("_h"))


def merkle_tree(leaves: DataFrame) -> DataFrame:
    """(warc_file, level, node, digest): all nodes over the leaves (warc_file, offset,
    length, digest). ``node`` numbers the offset ranges of a level from 0; the root is the
    only node of level ``LEVELS`` + 1. Lower nodes enter in the order of their offsets."""
    def up(below: DataFrame, node: Column, level: int) -> DataFrame:
        # What a node gathers is bounded by its range, whatever the corpus.
        rows = below.groupBy("warc_file", node.alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("at", "entry"))).alias("parts"))
        joined = F.array_join(F.transform("parts", lambda p: p["entry"]), "\n")
        return checkpointed(rows.select("warc_file", F.lit(level).alias("level"), "node",
                                        F.sha2(joined, 256).alias("digest")))

    entry = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "digest")
    nodes = up(leaves.select("warc_file", F.col("offset").alias("at"), entry.alias("entry")),
               F.floor(F.col("at") / RANGE_BYTES), 1)
    tree = nodes
    for level in range(2, LEVELS + 2):
        node = F.floor(F.col("at") / FANOUT) if level <= LEVELS else F.lit(0).cast("long")
        below = nodes.select("warc_file", F.col("node").alias("at"),
                             F.concat_ws(":", F.col("node").cast("string"), "digest").alias("entry"))
        nodes = up(below, node, level)
        tree = tree.unionByName(nodes)
    return tree


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(warc_file, offset, status) of the records at which a replica departs from the
    primary: ``damaged``, ``missing`` or ``foreign``. Both are leaves (warc_file, offset,
    length, digest). Only children of nodes that differ are read."""
    trees = [checkpointed(merkle_tree(leaves)) for leaves in (primary, replica)]

    def differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        b = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("digest").alias("_digest"))
        same = [F.col(k) == F.col(f"_{k}") for k in keys]
        return a.join(b, same, "full").where(~F.col("digest").eqNullSafe(F.col("_digest"))) \
                .select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys],
                        F.when(F.col("_digest").isNull(), "missing")
                         .when(F.col("digest").isNull(), "foreign").otherwise("damaged").alias("status"))

    def below(rows: DataFrame, parent: Column, bad: DataFrame) -> DataFrame:
        return rows.withColumn("_parent", parent) \
                   .join(bad.select("warc_file", F.col("node").alias("_parent")),
                         ["warc_file", "_parent"], "left_semi").drop("_parent")

    top = LEVELS + 1
    bad = checkpointed(differing(*[t.where(F.col("level") == top) for t in trees], ["warc_file", "node"]))
    for level in range(LEVELS, 0, -1):
        if bad.isEmpty():
            break
        parent = F.lit(0).cast("long") if level == LEVELS else F.floor(F.col("node") / FANOUT)
        a, b = (below(t.where(F.col("level") == level).drop("level"), parent, bad) for t in trees)
        bad = checkpointed(differing(a, b, ["warc_file", "node"]))
    a, b = (below(leaves.select("warc_file", "offset",
                                F.concat_ws(":", F.col("length").cast("string"), "digest").alias("digest")),
                  F.floor(F.col("offset") / RANGE_BYTES), bad) for leaves in (primary, replica))
    return differing(a, b, ["warc_file", "offset"])


def _rot(text: Column) -> Column:
    """Bit rot for drills: the last but fourth character, before the closing line ends, is
    replaced, so the length stays."""
    at = F.length(text) - 4
    return F.concat(F.substring(text, 1, at - 1),
                    F.when(F.substring(text, at, 1) == "#", "+").otherwise("#"), F.substring(text, at + 1, 4))


def fixity_drill(pages: DataFrame, every: int = 500) -> DataFrame:
    """Write all pages as WARC records and a second replica that has known faults, read
    both back and audit them: page_id, warc_file, offset, length, digest, root (of the
    primary's file), status (``ok``, ``damaged``, ``missing``) of every record.

    About one record in ``every`` has rotted in the replica and as many are lost, chosen by
    a hash of the page id. Null ids, urls and pages are empty parts of a record; repeated
    rows are records of their own; other columns are ignored; no pages give no rows.
    """
    spark = pages.sparkSession
    paths = [scratch_path(spark, f"warc_{name}") for name in ("primary", "replica")]
    kind = pages.schema["page_id"].dataType.simpleString()
    reader = spark.read.schema(f"page_id {kind}, offset long, record string, warc_file int")
    write_records(pages, paths[0])
    stored = reader.parquet(paths[0])
    fate = F.pmod(digest52(F.concat(F.lit("fate:"), key_text("page_id"))), F.lit(every))
    stored.where(fate != 1).withColumn("record", F.when(fate == 0, _rot(F.col("record"))).otherwise(F.col("record"))) \
          .write.partitionBy("warc_file").option("compression", "zstd").parquet(paths[1])
    leaves, replica = (checkpointed(read_records(records, "page_id"))
                       for records in (stored, reader.parquet(paths[1])))
    primary = leaves.drop("page_id")
    found = checkpointed(audit(primary, replica.drop("page_id")))
    roots = merkle_tree(primary).where(F.col("level") == LEVELS + 1) \
                                .select("warc_file", F.col("digest").alias("root"))
    return leaves.join(found, ["warc_file", "offset"], "left").join(roots, "warc_file") \
                 .select("page_id", "warc_file", "offset", "length", "digest", "root",
                         F.coalesce("status", F.lit("ok")).alias("status"))


def write_records(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """The records themselves as Parquet (page_id, warc_file, offset, record), a folder per
    file. Every row is a record at a place of its own, also null ids and repeated rows: the
    records are staged with a number of their row, which finds their places."""
    staged = scratch_path(pages.sparkSession, "warc_staged")
    pages.select(F.monotonically_increasing_id().alias("_row"), "page_id", record_text().alias("record")) \
         .write.option("compression", "zstd").parquet(staged)
    kind = pages.schema["page_id"].dataType.simpleString()
    records = pages.sparkSession.read.schema(f"_row long, page_id {kind}, record string").parquet(staged)
    sized = records.select("_row", "page_id", F.octet_length("record").cast("long").alias("length"),
                           F.sha2("record", 256).alias("digest"))
    places = lay_out(sized, file_bytes).select("_row", "warc_file", "offset")
    # The texts move once, to where their files are written; a file's are dealt over PARTS tasks.
    files = _files(sized.agg(F.sum("length")).first()[0], file_bytes)
    keys = ["warc_file", "_part", "_row"]
    part = F.pmod(F.xxhash64("_row"), F.lit(PARTS)).cast("int")
    records, places = (df.withColumn("_part", part).repartition("warc_file", "_part") for df in
                       (records.withColumn("warc_file", _file_of(files)), places))
    records.hint("shuffle_merge").join(places, keys) \
           .select("page_id", "warc_file", "offset", "record") \
           .write.partitionBy("warc_file").option("compression", "zstd").parquet(path)
    remove_scratch(pages.sparkSession, staged)


def read_records(records: DataFrame, *more: str) -> DataFrame:
    """Leaves (warc_file, offset, length, digest, and ``more`` columns) of stored records."""
    return records.select("warc_file", "offset", F.octet_length("record").cast("long").alias("length"),
                          F.sha2("record", 256).alias("digest"), *more)
