"""Tags, visibility and list markers of pages: cases, and a plain tokenizer of one character a step."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from llm_cases import SMALL
from kestrel.llm import html_layout as H
from kestrel.llm.common import table
from kestrel.llm.html_tags import Tag, tokens

SHOWN = {
    "<p title=Bob's>Hello <b>don't</b> world</p>": "Hello don't world",
    "<a href=\"x\"\">one two</a> three <a href=\"y\">four</a>": "one two three four",
    "<a href=x\">one</a> two": "one two", "<p \"a'>x</p>y": "x\n\ny", "a<b '>c</b>d": "acd", "<p a='>'>x": "x",
    "<p a=\"x>lost": "", "a </> b </ c> d": "a b d", "x</": "x</", "a<": "a<", "a <3 b <p": "a <3 b",
    "<div hidden=until-found>x</div>": "x", "a<!-->b<!--->c<!-- > --!>d<!-- ": "abcd", "<br/>a<br / >b": "\na\nb",
    "<script>a</script x='>' y>b": "b", "<script>a</scripty>b</script>c": "c", "<textarea><b></textarea >x": "<b>x",
    "<i style='display:\tnone'>no</i>x": "x", "<i style='display:/**/none'>no</i>x": "x",
    "<i style='display:none;display:inline'>x</i>": "x", "<i style='display:none!important;display:inline'>no</i>x": "x",
    "<i style='display:nothing'>x</i>": "x", "<i style=\"background:url('a;display:none')\">x</i>": "x",
    "<div style=visibility:hidden>no<b style=visibility:visible>yes</b>no</div>": "yes",
    "<div style='display:none'>no<b style='display:block;visibility:visible'>no</b></div>x": "x",
    "<div hidden style='display:block'>x</div>": "x", "<dialog>no</dialog><dialog open>x</dialog>": "x",
    "<ol><li style=visibility:hidden>no<li>b</ol>": "2. b", "<ol><li hidden>no<li>b</ol>": "1. b",
    "<table><tr><td style=visibility:hidden>no<td>b<tr><td>cc<td>d</table>": "    b\ncc  d",
    "<table><tr style=visibility:collapse><td>no<tr><td>x</table>": "x",
    "<style>.a{display:none} #b , p.c { visibility : hidden }</style><i class='x a'>no</i><i id=b>no</i>"
    "<p class=c>no</p><i class=c>yes</i>": "yes",
    "<style>p{display:none}p.y{display:block}</style><p>no<p class=y>yes": "yes",
    "<style>#y{display:block}p{display:none}</style><p>no<p id=y>yes": "yes",
    "<style>p{display:none!important}</style><p style='display:block'>no": "",
    "<style>p{display:none}</style><p style='display:block'>yes": "yes",
    "<style>@media print{p{display:none}} @media screen{i{display:none}}</style><p>yes<i>no</i>": "yes",
    "<style media=print>p{display:none}</style><p>yes": "yes", "<style>/* p{ */ i{display:none}</style><p>yes<i>no": "yes",
    "<style>div p{display:none} p:hover{display:none}</style><div><p>yes": "yes",
    "<style>p{color:red; .n{display:none;} }</style><p>yes": "yes", "<style>p{display:none": "",
    "<template><style>p{display:none}</style></template><p>yes": "yes", "<style><!-- i{display:none} --></style>x<i>no": "x",
    "<select><optgroup label=G><option>a<option>b</optgroup></select>": "G\na\nb",
    "<ol type=a start=26><li>x<li>y</ol>": "z. x\naa. y", "<ol type=I start=3><li>x<li>y</ol>": "III. x\nIV. y",
    "<ol reversed><li>x<li>y</ol>": "2. x\n1. y", "<ol type=i start=0><li>x<li>y</ol>": "0. x\ni. y",
    "<svg><g visibility=hidden><text>no</text><text visibility=visible>x</text></g></svg>": "x"}


@pytest.mark.parametrize("source", SHOWN)
def test_what_shows(source):
    assert H.extract(source) == SHOWN[source]


def plain_tokens(s):
    """The states of the HTML standard, a character a step: tags, and text between them."""
    out, i, blank = [], 0, " \t\n\r\f"
    while i < len(s):
        if s[i] != "<" or i + 1 == len(s) or not (s[i + 1].isascii() and s[i + 1].isalpha() or s[i + 1] in "/!?"):
            out.append(s[i])
            i += 1
            continue
        if s[i + 1] in "!?" or s[i + 1] == "/" and i + 2 < len(s) and not (s[i + 2].isascii() and s[i + 2].isalpha()):
            while i < len(s) and s[i] != ">":
                i += 1
            i += 1
            continue
        end = s[i + 1] == "/"
        if end and i + 2 == len(s):
            out += s[i:]
            break
        i += 2 if end else 1
        name = key = value = ""
        attrs, state, closed = {}, "name", False
        while True:
            if i >= len(s):
                return out
            c = s[i]
            i += 1
            if state in ("double", "single"):
                if c == ('"' if state == "double" else "'"):
                    attrs.setdefault(key, html.unescape(value))
                    state, key = "before", ""
                else:
                    value += c
                continue
            if c == ">":
                if state in ("key", "after"):
                    attrs.setdefault(key, "")
                elif state in ("value", "unquoted"):
                    attrs.setdefault(key, html.unescape(value))
                break
            if state == "name":
                if c in blank or c == "/":
                    state, closed = "before", c == "/"
                else:
                    name += c.lower()
            elif state in ("before", "after", "key"):
                if state == "key" and c not in blank + "/=":
                    key += c.lower()
                elif state != "before" and c == "=":
                    state, value = "value", ""
                elif c in blank:
                    state, closed = "after" if state != "before" else "before", False
                elif c == "/":
                    if state != "before":
                        attrs.setdefault(key, "")
                    state, closed = "before", True
                else:
                    if state == "after":
                        attrs.setdefault(key, "")
                    state, key, closed = "key", c.lower(), False
            elif state == "value":
                if c in blank:
                    continue
                state = "double" if c == '"' else "single" if c == "'" else "unquoted"
                if state == "unquoted":
                    value = c
                closed = False
            elif c in blank:
                attrs.setdefault(key, html.unescape(value))
                state, closed = "before", False
            else:
                value += c
        out.append((name, end, attrs, closed and state == "before"))
    return out


def test_tags_are_those_of_a_plain_tokenizer():
    draw = random.Random(5)
    for _ in range(20_000):
        s = "".join(draw.choice(["<", "<a", "</b", ">", "'", '"', "=", " ", "/", "x", "Y", "é", "&amp;", "\n", "<?", "1"])
                    for _ in range(draw.randrange(1, 25)))
        got, at = [], 0
        for start, end, what in tokens(s):
            got += s[at:start]
            at = end
            if what is not None:
                assert isinstance(what, Tag)
                got.append(tuple(what))
        assert got + list(s[at:]) == plain_tokens(s), s


@pytest.mark.parametrize("piece", ["<a ", "<a b='", "<a b=\"x", "</script ", "<!-- ", "<![CDATA[", "<a = ", "</", "<a/", "x=' "])
def test_time_grows_with_the_length(piece):
    for before in ("", "<a ", "<script>", "<style>"):
        began = time.process_time()
        H.extract(before + piece * (1_000_000 // len(piece)) + "'")
        assert time.process_time() - began < 20


def test_sheets_are_read_in_linear_time():
    for css in ("/* " * 300_000, "p{display:none" * 60_000, "(" * 900_000, "a{" * 400_000, '"\'' * 400_000):
        began = time.process_time()
        H.extract(f"<style>{css}</style><p>x")
        assert time.process_time() - began < 20


def test_edge_tables(spark):
    rows = [(1, None, "a"), (None, "<p>x", None), (None, "<p>x", "b"), (2, "", "c"), (3, "<b>" + "word " * 400_000, "d")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted(((r.page_id or 0, r.n_lines, len(r.text)) for r in H.extract_pages(pages).collect()))
    assert got == [(0, 1, 1), (0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 1, 400_000 * 5 - 1)]
    assert H.extract_pages(pages.limit(0)).count() == 0
    named = pages.select(F.col("page_id").alias("text"), F.col("html").alias("page_id"), F.lit(1).alias("n_lines"))
    assert sorted(r.n_lines for r in H.extract_pages(named, "text", "page_id").collect()) == [0, 0, 1, 1, 1]


def test_stray_quotes_lose_no_words(spark):
    """The given pages with quotes strewn into their tags show what they showed before."""
    draw = random.Random(3)
    for r in table(spark, SMALL, "pages").select("html").collect():
        if r.html:
            odd = re.sub(r"<(p|b|h1|article|nav|ul|li)>", lambda m: f"<{m[1]} {draw.choice(['x', chr(34), 'it' + chr(39) + 's'])}>", r.html)
            assert H.extract(odd) == H.extract(r.html)
