"""HTML layout, WARC fixity, SentencePiece encoding, and the pipeline end to end."""

import random
import re
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import MEDIUM, SMALL, edge_docs, no_docs  # noqa: F401
from kestrel.llm import html_layout as H
from kestrel.llm import unigram as U
from kestrel.llm import warc_fixity as W
from kestrel.llm.common import table
from kestrel.llm.queries import PIECES

CASES = {
    "<p>one<p>two <i>x</p>three": "one\n\ntwo x\n\nthree",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>a<li>b<li value=20>c</ol>": "9. a\n10. b\n20. c",
    "<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<br>c<td>22</table>": "Name   N\nalpha  1\nb      22\nc",
    "<table><tr><td rowspan=2>a<td>bb<tr><td>c</table>": "a  bb\n   c",
    "<table><tr><td colspan=2>wide cell<tr><td>x<td>y</table>": "wide cell\nx  y",
    "a  b\n c<br>d": "a b c\nd", "<pre> x\n  y </pre>z": " x\n  y\n\nz",
    "<div hidden>no</div><div style='display : none'>no</div><script>var t='</p>'</script>yes": "yes",
    "<details><summary>S</summary>closed</details><details open><summary>T</summary>open</details>": "S\nT\nopen",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e", "&lt;b&gt; &copy;<!-- c --> x<![CDATA[y]]>": "<b> © xy",
    "<select><option>a<option>b</select>": "a\nb", "<h1>T</h1><div>a</div><div>b</div>": "T\n\na\nb",
    "<b>bold<p>para</b> more": "bold\n\npara more", "": "", "<html><head><title>t</title></head></html>": "",
    "<blockquote>q</blockquote>": "  q", "< not a tag": "< not a tag", "x<textarea>a<b>c</textarea>": "xa<b>c"}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert H.extract(source) == CASES[source]


def test_deep_and_broken_pages_keep_their_text():
    assert H.extract("<div>" * 3000 + "x" + "<b><ul><li>" * 2000 + "y").split()[-1] == "y"
    assert H.extract(None) == "" and H.extract("<table>" * 500 + "z").strip() == "z"
    assert H.extract('<a href="x>unclosed') is not None


TABLES = [
    "<table><tbody>loose<tr><td>a<td>b</tr>more<b>bold</b><tr><td>c</tbody></table>",
    "<table><tbody><form><tr><td>a<td>b</tr><tr><td>c</form><tr><td>d</table>",
    "<table><form><tr><td>a</form><tr><td>b</table>", "<table><tbody><font><tr><td>a<tr><td>b</font></table>",
    "<table><thead><center><tr><th>a<th>b</center></thead><tbody><center>x<font>y<tr><td>c</center></table>",
    "<table><colgroup><col><col><tr><td>a<td>b</table>", "<table><colgroup><col><tbody><tr><td>a</table>",
    "<table><colgroup><td>a<td>b</table>", "<table><colgroup><col><thead><tr><th>a<tbody><tr><td>b</table>",
    "<table><colgroup><col>loose<tr><td>a</table>", "<table><colgroup><col><caption>a</caption><tr><td>b</table>",
    "<table><colgroup><col><colgroup><col><tfoot><tr><td>a</table>z", "<table><tbody><p>a<ul><li>b</ul></tbody></table>",
    "<table><tbody><tr><td><table><tbody>in<form><tr><td>a</table>b<tr><td>c</table>",
    "<table>one<tr><td>a</tr>two</table>", "<table><tbody>a<tbody>b</table>", "<table><div><span><tr><td>a</table>"]


@pytest.mark.parametrize("source", TABLES)
def test_all_words_of_odd_tables(source):
    marked = re.sub(r">([a-z]+)", lambda m: f">{m[1]}{m.start()}", source)  # words that differ
    want = re.findall(r">([a-z]+\d+)", marked)
    got = re.findall(r"[a-z]+\d+", H.extract(marked))
    assert want and sorted(got) == sorted(want)


def test_rows_in_wrappers_are_laid_out():
    rows = "<tr><td>a<td>bb</tr><tr><td>ccc<td>d</tr>"
    for source in (f"<tbody><form>{rows}</form></tbody>", f"<colgroup><col>{rows}", f"<font><center>{rows}",
                   f"<colgroup><col><tbody>{rows}"):
        assert H.extract(f"<table>{source}</table>") == "a    bb\nccc  d"
    assert H.extract(f"<table><form hidden>{rows}</form></table>") == ""
    assert H.extract(f"<table><details><summary>s</summary>{rows}</details></table>") == "s"


HEADS = {
    "<html><head><title>t</title><p>text <b>bold": "text bold", "<head><meta charset=x><style>s</style>plain": "plain",
    "<head><title>t</title>\n <link rel=x>\n<h1>H</h1>one": "H\n\none", "<head>&nbsp;x": "\xa0x",
    "<html><head><script>s</script><noscript>n</noscript><table><tr><td>a": "a", "<head><header>h</header>": "h",
    "<head><title>t</title></head><p>a": "a", "<head><title>t<body>a": "", "<head><template><p>no</template>yes": "yes",
    "<head><![CDATA[c]]>": "c", "<head><title>t</title><div hidden>no</div>a": "a",
    "a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b": "a x=2 b", "<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>": "1 2",
    "<math><semantics><mi>x</mi><annotation>no</annotation></semantics></math>": "x",
    "<svg><title>no</title><style/><path d='M0'/><g><text x=1>label <tspan>two</tspan></text></g><text>b</text></svg>c":
        "label two\nb\nc",
    "<svg><defs><text>no</text></defs><desc>no</desc><g display=none><text>no</text></g>no<rect/></svg>yes": "yes",
    "<svg><foreignObject><p>html</p></foreignObject><circle r='1'/><text>t</text></svg>": "html\n\nt",
    "<svg><path d='M0'><p>out of it</p>": "out of it", "<svg hidden><text>no</text></svg>x": "x",
    "<math><mi>x</mi><div>out</div>": "x\nout", "<svg><text><tspan x=0>a</tspan><tspan x=0>b</tspan></text></svg>": "a b"}


@pytest.mark.parametrize("source", HEADS)
def test_open_heads_and_drawings(source):
    assert H.extract(source) == HEADS[source]


@pytest.mark.parametrize("outer", ["<div>", "<font>", "<b>", "<span><div>", "<center><form>"])
def test_nothing_changes_with_depth(outer):
    for inner, want in (("<p hidden>no<b>no</b></p>yes", "yes"), ("<div style='display:none'><p>no<div>no</div></div>yes", "yes"),
                        ("<noscript><p>no</p></noscript>yes", "yes"), ("<template><p>no</p></template>yes", "yes"),
                        ("<svg><g><path/>no</g></svg>yes", "yes"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
                        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d")):
        for depth in (200, 5000):
            assert H.extract(outer * depth + inner) == want


def test_long_sloppy_and_deep_pages():
    rows = "<font><b><span>word <table><tr><td>a<td>bb</table>" * 20_000
    assert H.extract(rows) == "word\n\na  bb\n\n" * 19_999 + "word\n\na  bb"
    assert H.extract("<p><button>" + "<b><div>x" * 50_000).split() == ["x"] * 50_000
    deep = H.extract("<ul><li>x" * 20_000)
    assert deep.count("x") == 20_000 and max(map(len, deep.split("\n"))) <= H.MAX_INDENT + 1
    assert H.extract("<table><tr><td hidden>no<td>x" * 20_000).split() == ["x"] * 20_000
    assert H.extract("<svg><g>" * 20_000 + "<text>x") == H.extract("<math><mrow>" * 20_000 + "x") == "x"


class Words(HTMLParser):
    """All text outside of invisible elements, for the pages of the tests only."""

    def __init__(self):
        super().__init__()
        self.off, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_all_visible_words_of_the_pages(spark):
    pages = table(spark, MEDIUM, "pages")
    sources = {r.page_id: r.html for r in pages.collect()}
    for r in H.extract_pages(pages).collect():
        w = Words()
        w.feed(sources[r.page_id] or "")
        w.close()
        text = re.sub(r"(?m)^ *(- |\d+\. )", "", r.text)  # list markers
        assert "".join(text.split()) == "".join("".join(w.out).split())


# WARC

def test_audit_finds_every_fault(spark):
    pages = table(spark, MEDIUM, "pages").withColumn("status", F.lit("x"))
    got = W.fixity_drill(pages, every=9)
    n = {r["status"]: r["count"] for r in got.groupBy("status").count().collect()}
    assert got.count() == pages.count() and n["damaged"] > 10 and n["missing"] > 10
    assert got.select("page_id").distinct().count() == pages.count()


def test_stored_records_and_foreign_ones(spark, tmp_path):
    pages = table(spark, SMALL, "pages").limit(40)
    W.write_records(pages, f"{tmp_path}/a", file_bytes=20_000)
    stored = spark.read.parquet(f"{tmp_path}/a")
    leaves = W.read_records(stored)
    assert leaves.count() == 40 and leaves.select("warc_file").distinct().count() > 1
    one = stored.where("warc_file = 0").orderBy("offset").collect()
    at = 0
    for r in one:  # records stand one behind another and have their WARC parts
        assert r.offset == at and r.record.startswith("WARC/1.1\r\n") and r.record.endswith("\r\n\r\n")
        head, body = r.record[:-4].split("\r\n\r\n", 1)
        assert f"Content-Length: {len(body.encode())}" in head
        at += len(r.record.encode())
    assert W.audit(leaves, leaves).count() == 0
    extra = leaves.limit(1).withColumn("offset", F.lit(10**7).cast("long"))
    hurt = leaves.withColumn("digest", F.when((F.col("warc_file") == 0) & (F.col("offset") == 0), "bad")
                             .otherwise(F.col("digest"))).unionByName(extra)
    found = sorted((r.offset, r.status) for r in W.audit(leaves, hurt).collect())
    assert found == [(0, "damaged"), (10**7, "foreign")]
    assert [r.status for r in W.audit(leaves, leaves.where("warc_file <> 0")).collect()] == ["missing"] * len(one)


def test_warc_edge_rows(spark):
    rows = [(1, None, None), (None, "u", "h"), (2, "", ""), (2, "", ""), (3, "x", "é" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = W.fixity_drill(pages).collect()
    assert len(got) == 5 and len({(r.warc_file, r.offset) for r in got}) == 5
    assert W.fixity_drill(pages.limit(0)).count() == 0


def test_null_and_repeated_pages_are_written(spark, tmp_path):
    rows = [(1, None, None), (None, "u", "h"), (None, "u", "h"), (None, None, None), (3, "x", "é" * 2000)] + [(2, "", "")] * 30
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    W.write_records(pages, f"{tmp_path}/a", file_bytes=2000)
    stored = spark.read.parquet(f"{tmp_path}/a").collect()
    want = sorted(r.record for r in pages.select(W.record_text().alias("record")).collect())
    assert sorted(r.record for r in stored) == want and len({(r.warc_file, r.offset) for r in stored}) == len(rows)
    ends = {}
    for r in sorted(stored, key=lambda r: (r.warc_file, r.offset)):
        assert r.offset == ends.get(r.warc_file, 0)
        ends[r.warc_file] = r.offset + len(r.record.encode())


def test_drill_audits_stored_records(spark, monkeypatch):
    read, write = [], W.write_records

    def write_and_spoil(pages, path, *more):  # storage that loses a record
        write(pages.where("page_id <> 7"), path, *more)

    def read_records(records, *more, own=W.read_records):
        read.append(records.inputFiles())
        return own(records, *more)

    monkeypatch.setattr(W, "write_records", write_and_spoil)
    monkeypatch.setattr(W, "read_records", read_records)
    pages = spark.createDataFrame([(i, "u", "h") for i in range(40)], "page_id long, url string, html string")
    got = W.fixity_drill(pages, every=5).collect()
    assert len(got) == 39 and 7 not in {r.page_id for r in got}
    assert len(read) == 2 and all(read) and not set(read[0]) & set(read[1])
    assert {r.status for r in got} == {"ok", "damaged", "missing"}


# SentencePiece

@pytest.fixture(scope="module")
def model():
    return U.load_model(PIECES)


def best_score(model, table_of, text):
    s = U.MARK + text.replace(" ", U.MARK)
    best = [0.0] + [-np.inf] * len(s)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - 50), end):
            own = table_of.get(s[start:end])
            if own is None and end - start == 1:
                own = model.unknown
            if own is not None:
                best[end] = max(best[end], best[start] + own)
    return best[-1]


def test_viterbi_is_the_best_segmentation(model):
    ids_of = {int(i) for i in np.flatnonzero(model.byte_id >= 0)}
    table_of = {p: float(model.scores[i]) for i, p in enumerate(model.pieces)
                if i not in model.byte_of and not p.startswith("<") and ids_of}
    rng = random.Random(4)
    texts = ["hello world", "the theorem", "  two  spaces ", "naïve été Überraschung", "a" * 70, "x=1;y=2"]
    texts += ["".join(rng.choice("abcdeht ,éß") for _ in range(60)) for _ in range(60)]
    encoder = U.Encoder(model)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert model.scores[ids].sum() == pytest.approx(best_score(model, table_of, text))


def test_round_trip_and_byte_fallback(model):
    texts = ["", " ", "a\nb\tc", "日本語 😀😀", "  x ", "né\u0000é", "  𝒳 𓀀", "e" * 5000, "w " * 3000]
    for text, ids in zip(texts, U.Encoder(model).encode(texts)):
        assert U.decode(model, ids) == text
    ids = U.Encoder(model).encode(["𓀀"])[0]
    assert [model.pieces[i] for i in ids][-4:] == [f"<0x{b:02X}>" for b in "𓀀".encode()]


def test_memo_and_slices_change_nothing(model, monkeypatch):
    texts = ["one two three two", "two one", "drei vier"] * 3
    want = [list(i) for i in U.Encoder(model).encode(texts)]
    monkeypatch.setattr(U, "WORD_CACHE", 2)
    e = U.Encoder(model)
    assert [list(e.encode([t])[0]) for t in texts] == want


def test_words_are_checked_once(model, monkeypatch):
    """Counts and checks of remembered words give those of whole texts; no text is decoded."""
    texts = ["", "one two one", "日本語 𓀀 one", "a▁b", " ▁ two  ", "𓀀" * 3 + " 𓀀", "x\ty\nz", "two"] * 2
    whole = [(list(i), len(set(np.flatnonzero(np.isin(i, model.byte_id)))), U.decode(model, i) == t)
             for t in texts for i in U.Encoder(model).encode([t])]
    e = U.Encoder(model)
    monkeypatch.setattr(e, "decodes_to", None)  # called for words that don't decode to themselves
    ids, n_bytes, exact = e.encode_and_check(texts)
    assert [(list(i), n, x) for i, n, x in zip(ids, n_bytes, exact)] == whole
    assert [x for x, t in zip(exact, texts) if "▁" in t] == [False] * 4 and sum(exact) == 12
    assert len(e.memo) == len(e.exact) == len({w for t in texts for w in U.marked_words(t)})


def test_words_that_do_not_decode_to_themselves(model):
    e = U.Encoder(model)
    e.raw[:], e.size[:] = b"", 0  # no word passes the check of all words together
    texts = ["one 𓀀 two", "a▁b", "", "naïve"]
    assert e.encode_and_check(texts)[2] == [True, False, True, True]
    lone = U.Encoder(model)
    assert lone.encode_and_check(["a \ud800", "b"])[2] == [False, True]


def test_double_array_walk(model):
    trie = model.trie
    for i in random.Random(1).sample(range(300, 32000), 300):
        node = np.zeros(1, np.int32)
        for b in model.pieces[i].encode():
            node = trie.step(node, np.array([b]))
        assert trie.value[node[0]] == i
    assert trie.step(np.zeros(1, np.int32), np.array([255]))[0] == -1


def test_query_round_trips(spark, edge_docs, no_docs):
    docs = table(spark, SMALL, "documents")
    encoded = U.encode_documents(docs, PIECES)
    assert encoded.where("not exact").count() == 0
    texts = U.decode_documents(encoded, PIECES)
    assert texts.exceptAll(docs.select("doc_id", "text")).isEmpty()
    got = U.encode_documents(edge_docs, PIECES).collect()
    assert len(got) == edge_docs.count() and all(r.exact for r in got)
    assert {len(r.ids) for r in got if r.doc_id in (1, 2)} == {0}
    assert U.encode_documents(no_docs, PIECES).count() == 0


# pipeline

def test_pipeline_stages(spark, edge_docs, no_docs):
    import corpus_pipeline as P
    assert [f.__name__ for _, f in P.STAGES] == ["keep_good_quality", "drop_exact_copies", "drop_near_copies",
                                                 "mix_sources", "encode"]
    docs, counts = table(spark, SMALL, "documents"), []
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMALL).cache()
        assert out.columns == docs.columns
        counts.append(out.count())
        docs = out
    assert counts[0] >= counts[1] >= counts[2] > 0
    assert docs.join(table(spark, SMALL, "documents").select("doc_id"), "doc_id", "left_anti").isEmpty()
    assert P.run(spark, SMALL).count() == counts[3]


def test_pipeline_on_awkward_and_empty_tables(spark, edge_docs, no_docs):
    import corpus_pipeline as P
    for docs in (edge_docs, no_docs):
        d = docs
        for _, stage in P.STAGES[:-1]:
            d = stage(spark, d, SMALL)
            assert d.columns == docs.columns
        assert P.STAGES[-1][1](spark, d, SMALL).where("not exact").isEmpty()
