"""DartMinHash near-duplicates against all pairs by brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_cases import MEDIUM, edge_docs, no_docs  # noqa: F401
from kestrel.llm import near_dedup as N
from kestrel.llm.common import table


def brute_classes(rows, similarity=0.8, words=5):
    """Classes of (doc_id, text) by exact weighted Jaccard of all pairs sharing a shingle."""
    def shingles(t):
        w = (t or "").lower().split()
        n = min(words, len(w))
        return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_text, posting = {}, defaultdict(list)
    for i, (_, t) in enumerate(rows):
        parent[find(i)] = find(by_text.setdefault(t or "", i))
    for i, s in enumerate(sets):
        shared = Counter()
        for x, n in s.items():
            for j in posting[x]:
                shared[j] += min(n, sets[j][x])
            posting[x].append(i)
        for j, both in shared.items():
            if both >= similarity * (s.total() + sets[j].total() - both):
                parent[find(i)] = find(j)
    groups = defaultdict(set)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].add(d)
    return {d: min(g) for g in groups.values() for d in g}, sets


@pytest.fixture(scope="module")
def corpus(spark):
    docs = table(spark, MEDIUM, "documents")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_classes_equal_brute_force(spark, corpus):
    docs, rows = corpus
    want, _ = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert got == want
    assert len(set(want.values())) < len(want) - 50  # there is something to find


@pytest.mark.parametrize("slim", [N.SLIM_ROWS, 6])  # loop tables in one task, and shuffled
def test_leaders_find_links_that_the_first_misses(spark, monkeypatch, slim):
    """A chain: the least document is similar to the second only, that to the third..."""
    monkeypatch.setattr(N, "SLIM_ROWS", slim)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(8):
        w = list(base)
        for i in range(step * 3):
            w[i * 7 % 200] = f"x{i}"
        rows.append((step, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert got == want


def test_large_groups_of_near_copies(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(400):
        w = list(base)
        for i in rng.integers(0, 300, 2):
            w[i] = f"y{d}"
        rows.append((d, " ".join(w)))
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    want, _ = brute_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert got == want


def test_rounds_do_not_multiply_size_estimates(spark):
    """A chain takes many rounds, and every round joins what the one before made."""
    n = 64
    labels = spark.range(n).selectExpr("id AS node", "id AS comp")
    links = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b")
    out = N.components(labels, links, n)
    assert sorted(tuple(r) for r in out.select("node", "comp").collect()) == [(i, 0) for i in range(n)]
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 64


def test_tables_of_the_rounds_are_removed(spark, monkeypatch):
    folders = []
    monkeypatch.setattr(N, "scratch_path", lambda *a, f=N.scratch_path: folders.append(f(*a)) or folders[-1])
    words = [f"w{i}" for i in range(100)]
    rows = [(d, " ".join([*words, f"y{d}"])) for d in range(5)]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.class_id for r in found.collect()} == {0}
    assert folders
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_signature_agreement_is_weighted_jaccard():
    s = N.Shingles(1)
    a = s.elements(" ".join(["a"] * 10 + ["b"] * 5 + [f"c{i}" for i in range(85)]))
    b = s.elements(" ".join(["a"] * 4 + ["b"] * 5 + [f"c{i}" for i in range(60)]))
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert exact == pytest.approx(69 / 100)
    sig = N.dart_signatures([a, b, a], 4096)
    assert (sig[0] == sig[2]).all()
    assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.03)


def test_signature_does_not_depend_on_its_batch():
    s = N.Shingles(5)
    sets = [s.elements(" ".join(f"{d}-{i}" for i in range(n))) for d, n in enumerate((5, 7, 400, 9000))]
    together = N.dart_signatures(sets, 300)
    for e, row in zip(sets, together):
        assert (N.dart_signatures([e], 300)[0] == row).all()


def test_edge_rows(spark, edge_docs, no_docs):
    out = {}
    for r in N.near_duplicates(edge_docs).collect():
        out.setdefault(r.doc_id, []).append((r.class_id, r.class_size, r.kept))
    assert out[1] == [(1, 2, True)] and out[2] == [(1, 2, False)]  # null and empty
    assert out[3] == [(3, 1, True)]
    assert sorted(out[4]) == [(4, 3, False), (4, 3, True)] and out[5] == [(4, 3, False)]
    assert sorted(out[7]) == [(6, 2, False), (7, 1, True)]
    assert N.near_duplicates(no_docs).count() == 0
    kept = N.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 8, 9]
    assert N.drop_near_duplicates(no_docs).count() == 0
