"""Exact dedup, sharding, mixing and the classifier: laws, skew, awkward rows."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import MEDIUM, edge_docs, no_docs  # noqa: F401
from kestrel.llm import exact_dedup, mixing, quality, sharding
from kestrel.llm.common import running_sum, table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, MEDIUM, "documents")


# exact dedup

def test_radix_parameters_change_nothing(spark, docs):
    base = exact_dedup.equal_text_groups(docs)
    tiny = exact_dedup.equal_text_groups(docs, first_bytes=3, growth=9, salts=2)
    assert base.exceptAll(tiny).isEmpty() and tiny.exceptAll(base).isEmpty()


def test_shared_prefixes_and_hot_group(spark):
    text = "é" * 700
    rows = [(i, text) for i in range(300)] + [(1000 + i, text + "x" * i) for i in range(1, 40)] \
        + [(2000, text[:-1]), (2001, text + "x" * 7)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.equal_text_groups(d).collect()}
    assert got[5] == (299, 300, False) and got[299] == (299, 300, True)
    assert got[1007] == (2001, 2, False) and got[2001] == (2001, 2, True) and got[2000] == (2000, 1, True)


def test_exact_edge_rows(edge_docs, no_docs):
    got = defaultdict(list)
    for r in exact_dedup.equal_text_groups(edge_docs).collect():
        got[r.doc_id].append((r.keep_id, r.group_size, r.kept))
    assert got[1] == [(2, 2, False)] and got[2] == [(2, 2, True)]
    assert got[4] == [(5, 3, False)] * 2 and got[5] == [(5, 3, True)]
    assert sorted(got[7]) == [(7, 1, True), (7, 2, True)] and got[None] == [(None, 1, True)]
    kept = exact_dedup.drop_equal_texts(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == 8
    assert exact_dedup.equal_text_groups(no_docs).count() == 0
    assert exact_dedup.drop_equal_texts(no_docs).count() == 0


def test_repeated_row_is_kept_once(spark):
    d = spark.createDataFrame([(4, "one")] * 5 + [(3, "one"), (9, "two")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.drop_equal_texts(d).collect()) == [4, 9]


# sharding

def test_new_shard_only_takes_rows_into_itself(docs):
    for r in sharding.assign_shards(docs).collect():
        assert r.grown_shard in (r.shard, 8)


def test_slots_have_no_gaps_and_shards_are_even(docs):
    by = defaultdict(list)
    for r in sharding.assign_shards(docs).collect():
        by[r.shard].append(r.slot)
    assert set(by) == set(range(8))
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots))) and 80 < len(slots) < 180


def test_weights_move_rows_only_to_and_from_their_subtree(spark):
    d = spark.range(20_000).withColumn("text", F.lit("x"))
    pick = lambda w: d.select("id", sharding.shard_of(F.col("id"), sharding.tree(8, weights=w)).alias("s"))
    moved = pick({}).join(pick({2: 3.0}).withColumnRenamed("s", "t"), "id").where("s <> t") \
                    .groupBy("s", "t").count().collect()
    # shard 2 is in rack 1 of region 0: inside other racks and regions nothing moves
    assert all(r.t in (0, 1, 2, 3) for r in moved)
    assert not any(r.s in (0, 1) and r.t in (0, 1) or r.s >= 4 and r.t >= 4 for r in moved)
    share = pick({2: 3.0}).where("s = 2").count() / 20_000
    assert share == pytest.approx(0.3, abs=0.02)


def test_shard_edge_rows(edge_docs, no_docs):
    got = sharding.assign_shards(edge_docs).collect()
    assert len(got) == edge_docs.count()
    sizes = {r.doc_id: (r["size"], r.text_crc32) for r in got}
    assert sizes[1] == (1, 0) and sizes[2] == (1, 0) and sizes[4] == (4, zlib.crc32(b"one"))
    assert sharding.assign_shards(no_docs).count() == 0


def test_running_sum_does_not_depend_on_buckets(spark):
    d = spark.range(500).select(F.lit(0).alias("g"), (F.col("id") * 9007199254).alias("h"), "id",
                                F.lit(2).alias("v"))
    a, b = (running_sum(d, "g", "h", ["id"], "v", "s", n) for n in (1, 37))
    assert a.exceptAll(b).isEmpty() and a.agg(F.max("s")).first()[0] == 998


# mixing

def test_targets_are_met_and_capped(docs):
    rows = mixing.allocate(docs).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
    for r in docs.join(mixing.allocate(docs), "doc_id").collect():
        by[r.source][0] += r.taken
        by[r.source][1:] = r.source_size, r.target
    total = sum(s for _, s, _ in by.values())
    assert sum(t for *_, t in by.values()) == pytest.approx(1.5 * total)
    for i, (_, (taken, size, target)) in enumerate(sorted(by.items())):
        assert abs(taken - target) <= 1 and target <= 2 * size + 1e-6
    level = {w: {round(t / w, 3) for i, (_, (_, s, t)) in enumerate(sorted(by.items()))
                 if (5, 2, 1)[i % 3] == w and t < 2 * s - 1} for w in (5, 2, 1)}
    assert len(set().union(*level.values())) == 1  # all that aren't capped share by weight


def test_schedule_is_inverted(docs):
    """Up to every time, a source has given the words that its schedule demands."""
    rows = docs.join(mixing.allocate(docs), "doc_id").collect()
    for no, source in enumerate(sorted({r.source for r in rows})):
        tilt = mixing.TILTS[no % 3]
        passes = sorted((p, t) for r in rows if r.source == source
                        for p, t in ((r.position_1, r.take_1), (r.position_2, r.take_2)) if t)
        given, target = 0, sum(t for _, t in passes)
        for p, t in passes:
            assert given == pytest.approx(target * (p + tilt * (p * p - p)), abs=1.0)
            given += t


def test_training_order(docs):
    rows = mixing.training_order(docs)
    assert rows.columns == docs.columns
    want = docs.join(mixing.allocate(docs), "doc_id")
    taken = want.agg(F.sum("taken")).first()[0]
    got = rows.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert got == taken
    assert [r.doc_id for r in rows.take(3)] == \
        [r.doc_id for r in want.where("position_1 is not null").orderBy("position_1", "doc_id").take(3)]


def test_mix_edge_rows(spark, edge_docs, no_docs):
    got = mixing.allocate(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert {r.doc_id: r.taken for r in got if r.doc_id in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    assert mixing.allocate(no_docs).count() == 0 and mixing.training_order(no_docs).count() == 0
    empty = spark.createDataFrame([(1, "", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.allocate(empty).collect()] == [(0, 0.0, 0)] * 2


def test_native_plan(docs):
    plan = mixing.allocate(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# classifier

def test_held_out_accuracy(spark):
    d = table(spark, "/root/testdata/sf0.1", "documents")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    rows = quality.classify(d, labels).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    assert right > 0.99 and all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.quality == 1 and r.predicted == 0]


def test_held_out_labels_are_never_learnt(spark, docs):
    labels = table(spark, MEDIUM, "labels")
    lie = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")) \
           .otherwise(F.col("quality"))
    a = quality.classify(docs, labels)
    b = quality.classify(docs, labels.withColumn("quality", lie))
    assert a.exceptAll(b).isEmpty()


def test_quality_edge_rows(spark, edge_docs, no_docs):
    labels = table(spark, MEDIUM, "labels")
    got = quality.classify(edge_docs, labels).collect()
    assert len(got) == edge_docs.count()
    none = spark.createDataFrame([], labels.schema)
    assert {r.score for r in quality.classify(edge_docs, none).collect()} == {0.5}
    assert quality.classify(no_docs, none).count() == 0
    assert quality.keep_good(edge_docs, labels, threshold=0.0).columns == edge_docs.columns
