"""Periodic runs: every run against a plain scan of all lags."""

import random

import numpy as np
import pytest

from llm_cases import edge_docs, no_docs  # noqa: F401
from kestrel.llm import periodic_runs as P


def all_lags(words):
    """Every stretch in which words q apart are equal, for every q; the least q of a stretch."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sequence(rng):
    words, n, letters = [], rng.randint(0, 200), rng.choice([1, 2, 3, 5, 30])
    while len(words) < n:
        if rng.random() < 0.4:
            period = [rng.randrange(letters) for _ in range(rng.randint(1, 25))]
            words += (period * 99)[:rng.randint(1, 6 * len(period) + 20)]
        else:
            words += [rng.randrange(60) for _ in range(rng.randint(1, 10))]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_a_scan_of_all_lags(seed):
    rng = random.Random(seed)
    total = 0
    for _ in range(150):
        words = sequence(rng)
        want = all_lags(words)
        total += len(want)
        assert P.runs_of(np.array(words, np.int64)) == want
    assert total > 50


def test_splitting_loses_no_run_and_recurses():
    # The outer words are rare; without them the words of the middle become rare in turn.
    middle = list(range(100, 140)) + [7, 8] * 20 + list(range(100, 140))
    words = np.array([1] + middle + [2])
    assert P.segments(words) == [(41, 81)]
    assert P.runs_of(words) == [(41, 40, 2)]


def test_a_deep_cascade_and_a_uniform_text_are_fast():
    deep = np.array([w for i in range(30_000) for w in (i, i, i + 1)])
    assert P.runs_of(deep) == []
    assert P.runs_of(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def test_overlapping_runs_and_what_is_kept():
    words = np.array([1, 2] * 15 + [1, 2, 3, 4, 5, 6, 7, 8] * 5)
    runs = P.runs_of(words)
    assert runs == all_lags(words.tolist()) and len(runs) == 2
    kept = P.kept_words(len(words), runs)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    assert [i for i, k in enumerate(kept) if not k] == sorted(dropped)


def test_edge_rows(spark, edge_docs, no_docs):
    from pyspark.sql import functions as F
    words = edge_docs.withColumn("words", P.words_of("text"))
    rows = P.find_runs(words).collect()
    assert len(rows) == words.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].n_words == 0 and by_id[1].runs == [] and by_id[1].collapsed == ""
    assert by_id[3].collapsed == "" and by_id[4].collapsed == "one"
    assert [tuple(r) for r in by_id[9].runs] == [(0, 30_000, 1)] and by_id[9].collapsed == "word"
    assert sum(r.doc_id == 4 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    nulls = words.where("doc_id = 4").withColumn("words", F.expr("array('a', null, 'b')"))
    assert P.find_runs(nulls).first().collapsed == "a  b"
    assert P.find_runs(no_docs.withColumn("words", P.words_of("text"))).collect() == []
    missing = words.where("doc_id = 4").withColumn("words", F.lit(None).cast("array<string>"))
    assert P.find_runs(missing).first().n_words == 0


def test_words_split_on_ascii_white_space_only(spark):
    d = spark.createDataFrame([("a\x0b\x0cb c d\x1fe \r\nf",)], "text string")
    assert d.select(P.words_of("text").alias("w")).first().w == ["a", "b c d\x1fe", "f"]


def test_greatest_exponent_is_exact_and_ties_go_by_start(spark):
    big = 3 * 10 ** 9
    runs = [(0, 24, 8), (50, 30, 10), (99, 3 * big + 1, big), (200, 6, 2)]
    d = spark.createDataFrame([(runs,), ([],), (runs[:2],)], f"runs {P.RUNS}")
    got = [r[0] and tuple(r[0]) for r in d.select(P.longest_by_exponent()).collect()]
    assert got == [(99, 3 * big + 1, big), None, (0, 24, 8)]


def test_planted_documents_have_the_planted_run(spark):
    import zlib
    from kestrel.llm.queries_runs import planted_words
    text = " ".join(f"w{i}" for i in range(400))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    d = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string") \
             .withColumn("words", P.words_of("text")).withColumn("words", planted_words())
    for r in P.find_runs(d).collect():
        g = zlib.crc32(str(r.doc_id).encode()) // 10
        a = g % 400
        p = 1 + (400 - a) // (3 + g % 8)
        want = [(a, 400 - a, p)] if 400 - a >= max(24, 3 * p) else []
        assert [tuple(x) for x in r.runs] == want
