"""Cross-polytope search: recall and order against every pair."""

import numpy as np
import pytest

from kestrel.llm import vector_search as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, queries, k=10):
    out = {}
    x = np.asarray(vectors, np.float32).astype(np.float64)
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:k]
        out[q] = [(i, d[i]) for i in order]
    return out


def found_by(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_pseudo_rotations_keep_lengths_and_hash_copies_alike():
    x = np.random.default_rng(0).normal(size=(50, 24))
    x[7] = x[3] * 5  # the same direction
    columns = V.unit_columns(x)
    assert columns.shape == (32, 50)
    for t in (0, 5):
        y = V.turned(columns, t)
        assert np.allclose((y * y).sum(axis=0), 1, atol=1e-5)
        codes = V.nearest_axes(y)
        assert codes[7] == codes[3]
        best = np.concatenate([y, -y])
        assert (np.abs(best[codes // 2 + 32 * (codes % 2), np.arange(50)] - best.max(axis=0)) < 1e-6).all()


@pytest.mark.parametrize("kind", ["isotropic", "clustered"])
def test_recall(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(16_000, 64))
    if kind == "clustered":
        x = x * 0.3 + rng.normal(size=(20, 64))[rng.integers(0, 20, len(x))]
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    d = frame(spark, x.tolist()).repartition(2, "vec_id")
    queries = list(range(0, len(x), 400))
    got = found_by(V.search(d, d.where("vec_id % 400 = 0")))
    want = brute(x, queries)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in queries]
    assert all(len(got[q]) == 10 for q in queries)
    assert np.mean(hits) >= 0.9, np.mean(hits)
    for q in queries:  # what was found is ranked and scored exactly
        true = dict(brute(x, [q], len(x))[q])
        assert [s for _, s in got[q]] == pytest.approx([true[i] for i, _ in got[q]], rel=1e-12)
        assert got[q] == sorted(got[q], key=lambda e: (e[1], e[0]))


def test_fewer_candidates_than_rows_are_compared(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12_000, 64)).astype(np.float32)
    batch = V._shard(64, list(range(len(x))), x).to_pylist()[0]
    rows = np.frombuffer(batch["rows"], np.uint16).reshape(V.TABLES, -1)
    starts = np.frombuffer(batch["starts"], np.int32).reshape(V.TABLES, -1)
    asked = V.Queries(64, list(range(20)), x[:20].tolist(), V.PROBES)
    share = np.mean([len(asked.candidates(q, rows, starts)) for q in range(20)]) / len(x)
    assert share < 0.6
    one = V.Queries(64, [0], x[:1].tolist(), 1)  # widened until there are enough
    assert len(one.candidates(0, rows, starts)) >= V.LEAST
    assert all(0 in one.candidates(0, rows, starts) for _ in range(1))


def test_exact_mode_and_blocks_of_queries(spark):
    x = np.random.default_rng(5).normal(size=(300, 8)).astype(np.float32)
    d = frame(spark, x.tolist())
    got = found_by(V.search(d, d.where("vec_id % 10 = 0"), probes=None, numbers_per_block=40))
    want = brute(x, range(0, 300, 10))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_awkward_vectors_take_no_part(spark):
    good = [[1, 0], [0.9, 0.1], [0, 1], [3, 4]]
    bad = [None, [], [0, 0], [None, 1], [float("nan"), 1], [float("inf"), 0], [1, 2, 3]]
    d = frame(spark, good + bad, list(range(4)) + [100, 101, 102, 103, 104, 105, 106])
    got = found_by(V.search(d, d))
    assert set(got) == {0, 1, 2, 3}  # the only vector of three components has nobody to meet
    assert [i for i, _ in got[0]] == [1, 2, 3]
    assert found_by(V.search(d.limit(0), d)) == {} and found_by(V.search(d, d.limit(0))) == {}


def test_ties_repeated_rows_and_null_ids(spark):
    rows = [[1.0, 0.0]] * 40 + [[0.0, 1.0]]
    ids = [None, None] + list(range(100, 138)) + [200]
    d = frame(spark, rows, ids)
    got = found_by(V.search(d, d.where("vec_id in (100, 200)")))
    assert [i for i, _ in got[100]] == list(range(101, 111))
    assert [i for i, _ in got[200]] == list(range(100, 110))
    few = frame(spark, [[1.0, 0.0]] * 3, [5, None, 7])
    assert [i for i, _ in found_by(V.search(few, few.where("vec_id = 5")))[5]] == [7, None]
    twice = frame(spark, [[1.0, 0.0], [0.5, 0.0], [0.5, 0.0], [0.25, 0.0]], [1, 2, 2, 1])
    asked = found_by(V.search(twice, twice.where("vec_id = 1")))
    assert asked == {1: [(2, 0.25), (2, 0.25)]}  # the least vector of id 1 asks


def test_a_vector_that_most_rows_share(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[500:2500] = x[500]
    d = frame(spark, x.tolist())
    got = found_by(V.search(d, d.where("vec_id in (0, 500)")))
    assert got[500] == [(i, 0.0) for i in range(501, 511)]
    assert len(got[0]) == 10
