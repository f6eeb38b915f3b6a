"""Max-sketch search against scoring every document."""

import math
from collections import Counter

import numpy as np

from llm_cases import edge_docs, no_docs  # noqa: F401
from kestrel.llm import lexical_search as L


def brute(docs, items, k=10):
    bags = [(i, Counter(L.terms_of(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    words = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items:
        scored = []
        for i, bag in bags:
            m = 25 + (75 * sum(bag.values()) * n_docs) // words if words else 25
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t, c in Counter(L.terms_of(text)).items() if bag[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out[item] = [(None if none else i, -s) for s, none, i in sorted(scored)[:k]]
    return {i: v for i, v in out.items() if v}


def found_by(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.item_id, [])) + 1
        out[r.item_id].append((r.doc_id, r.score))
    return out


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(3000)]
    weights = 1 / np.arange(1, 3001)
    weights /= weights.sum()
    docs = [(i, " ".join(rng.choice(words, size=int(rng.integers(0, 300)), p=weights))) for i in range(n)]
    items = [(i, " ".join(rng.choice(words, size=25, p=weights))) for i in range(30)]
    docs += [(n + i, f"{text} and more") for i, (_, text) in enumerate(items[:5])]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_equals_scoring_every_document(spark, monkeypatch):
    docs, items = corpus(1500)
    d, q = frames(spark, docs, items)
    want = brute(docs, items)
    assert found_by(L.search(d.repartition(3), q)) == want
    # Small shards, and several blocks of queries: the same answer.
    monkeypatch.setattr(L, "SHARD_DOCS", 100)
    assert found_by(L.search(d.repartition(2), q, terms_per_block=60)) == want


def test_bounds_hold_and_spare_most_documents():
    docs, items = corpus(2000, 1)
    builder = L._Builder()
    for i, t in docs:
        builder.add(i, t)
    row = next(builder.row().itertuples(index=False))
    block = L.Block([(i, sorted(Counter(L.terms_of(t))), [c for _, c in sorted(Counter(L.terms_of(t)).items())])
                     for i, t in items])
    n_words = sum(builder.lengths)
    shard = L.Shard(row, block, lambda n: 25 + 75 * n * len(docs) // n_words)
    df = np.bincount(shard.terms, minlength=len(block.terms))
    weights = L.term_weights(df, len(docs))
    places = np.array([L.place(t) for t in block.terms])
    for terms, counts in block.queries:
        table = np.zeros(L.WIDTH)
        np.add.at(table, places[terms], weights[terms] * counts)
        exact = np.zeros(len(block.terms), np.int64)
        exact[terms] = weights[terms] * counts
        assert (shard.sketch @ table * (1 + 1e-9) >= shard.scores(np.arange(len(docs)), exact)).all()
    best = {}
    rescored, all_of_them = L.search_shard(shard, block, weights, best, 10)
    assert rescored < 0.5 * all_of_them


def test_terms():
    assert L.terms_of("Ab-9_É é x\x7fY") == [t.encode() for t in ("ab", "9", "É", "é x", "y")]
    assert L.terms_of(None) == [] and L.terms_of("") == []


def test_terms_column_agrees(spark):
    texts = ["Ab-9_É é x\x7fY", "", "日本 ß İI", "\x00a\x80b"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in d.select(L.terms_column("text")).collect()]
    assert got == [[t.decode() for t in L.terms_of(x)] for x in texts]


def test_edge_rows(spark, edge_docs, no_docs):
    items = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (4, "absent"), (5, "one one WORD été"), (None, "one")]
    q = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = L.search(edge_docs, q).collect()
    want = brute(rows, dict((i, (i, t)) for i, t in items if i is not None and t).values())
    for item in (1, 5):
        mine = [(r.doc_id, r.score) for r in sorted((r for r in got if r.item_id == item), key=lambda r: r["rank"])]
        assert mine == want[item]
    assert {r.item_id for r in got} == {None, 1, 5}
    assert L.search(no_docs, q).collect() == []
    assert L.search(edge_docs, q.limit(0)).collect() == []


def test_ties_go_by_id_and_copies_are_whole(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here")] + [(99, "other")] * 60
    d, q = frames(spark, docs, [(7, "same words")])
    assert [i for i, _ in found_by(L.search(d.repartition(4), q))[7]] == list(range(1, 11))
    few = d.where("doc_id is null or doc_id in (3, 4)")
    assert [i for i, _ in found_by(L.search(few.union(d.where("doc_id = 99")), q))[7]] == [3, 4, None]
