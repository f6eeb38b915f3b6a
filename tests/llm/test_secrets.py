"""Secret spans: the base patterns by brute force, and planted nested encodings."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pytest
import zstandard

from llm_cases import MEDIUM, edge_docs, no_docs  # noqa: F401
from kestrel.llm import secret_scan as S
from kestrel.llm.common import table

SECRET = 'password = "hunter2hunter2"'


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def percent(x):
    return "".join(f"%{b:02x}" for b in (x if isinstance(x, bytes) else x.encode()))


LAYERS = {
    "base64": b64(SECRET), "url": urllib.parse.quote(SECRET, safe=""), "every byte": percent(SECRET),
    "url twice": urllib.parse.quote(urllib.parse.quote(SECRET, safe=""), safe=""),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET), "html": "".join(f"&#{ord(c)};" for c in SECRET),
    "braces": "".join(f"\\u{{{ord(c):x}}}" for c in SECRET), "hex escapes": "".join(f"\\x{ord(c):02x}" for c in SECRET),
    "base64 thrice": b64(b64(b64(SECRET))), "gzip": b64(gzip.compress(SECRET.encode())),
    "zlib of base64": b64(zlib.compress(b64(SECRET).encode())), "bz2": b64(bz2.compress(SECRET.encode())),
    "zstd": b64(zstandard.compress(SECRET.encode())), "url of gzip": percent(gzip.compress(SECRET.encode())),
    "url safe": base64.urlsafe_b64encode(("??>>" + SECRET).encode()).decode().rstrip("="),
    "gzip of gzip": b64(gzip.compress(gzip.compress(SECRET.encode()))),
    "url of base64 of unicode": urllib.parse.quote(b64("".join(f"\\u{ord(c):04x}" for c in SECRET)), safe="")}


@pytest.mark.parametrize("layer", LAYERS)
def test_nested_layers_map_to_the_text(layer):
    before, after = "né 日本 ", " then the prose goes on."
    base, spans, layers, packed = S.scan(before + LAYERS[layer] + after)
    assert base == [] and layers >= 1 and packed == 0
    assert any(kind == "assign" and start >= len(before) and end <= len(before) + len(LAYERS[layer])
               for start, kind, end in spans)


def test_span_of_an_inner_part():
    inner = "x" * 30 + " " + SECRET + " " + "y" * 30
    text = f"a {b64(inner)} b"
    (start, kind, end), = S.scan(text)[1]
    assert kind == "assign" and text[start:end] in b64(inner) and end - start < len(b64(inner)) - 60


def test_partly_escaped_value_keeps_the_base():
    base, spans, _, _ = S.scan("token = abcdefgh%2Fijklmnop")
    assert [(0, "assign", 16)] == base and (0, "assign", 27) in spans and base[0] in spans


def test_fixpoint_ends():
    assert S.scan("%25" * 2000 + "41")[3] == 0
    assert S.scan("%2525252541 " * 50)[2] < 400


def test_bomb_is_left_packed(monkeypatch):
    monkeypatch.setattr(S, "MAX_LAYER_BYTES", 1 << 16)
    assert S.scan(b64(gzip.compress(b"a" * (1 << 20))))[3] == 1


def big(secret="", before=b""):
    """Words that unpack to more than the bound of the test, with a secret among them."""
    return before + b"word, " * 30_000 + secret.encode() + b" more." * 30_000


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, zlib.compress, zstandard.compress])
def test_secrets_after_and_in_a_bomb(monkeypatch, pack):
    monkeypatch.setattr(S, "MAX_LAYER_BYTES", 1 << 16)
    for encode in (b64, percent):
        bomb = encode(pack(big()))
        text = f"{bomb} then {b64(SECRET)} and {urllib.parse.quote(SECRET, safe='')}"
        base, spans, _, packed = S.scan(text)
        assert base == [] and packed >= 1 and all(start > len(bomb) for start, _, _ in spans)
        assert len(spans) == 2
        for hidden in (SECRET, b64(SECRET), b64(gzip.compress(SECRET.encode())), "x" + " " * 9000,
                       "password" + " " * 100_000 + "= hunter2hunter2", b64("filler " * 2000 + SECRET)):
            bomb = encode(pack(big(f" {hidden} ")))
            spans = S.scan(f"a {bomb} b")[1]
            assert spans == ([] if hidden[0] == "x" else [(2, "assign", 2 + len(bomb))])
        twice = encode(pack(pack(big(SECRET, random.Random(1).randbytes(1 << 17)))))
        assert S.scan(twice)[1] == [(0, "assign", len(twice))]


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zlib.compress, zstandard.compress])
def test_all_members(monkeypatch, pack):
    skipped = (0x184D2A50).to_bytes(4, "little") + (2000).to_bytes(4, "little") + bytes(2000)
    for parts in ([pack(b"one\n"), pack(SECRET.encode())], [pack(b"one")] * 50 + [pack(SECRET.encode())],
                  [pack(b"pass"), pack(b"word = hunter2"), pack(b"hunter2")],
                  [pack(b"one"), bytes(512), pack(SECRET.encode())], [pack(b""), pack(SECRET.encode())],
                  [pack(b"one"), gzip.compress(SECRET.encode())], [skipped, pack(SECRET.encode())][pack is not zstandard.compress:],
                  [pack(random.Random(2).randbytes(200_000).hex("\n").encode()), pack(SECRET.encode())]):
        for encode in (b64, percent):
            text = encode(b"".join(parts))
            assert (0, "assign", len(text)) in S.scan(text)[1]
    monkeypatch.setattr(S, "MAX_LAYER_BYTES", 1 << 16)
    text = b64(pack(big()) + pack(big(b64(SECRET) + " ")))
    assert S.scan(text)[1] == [(0, "assign", len(text))]


UNCLEAN = {
    "utf-16le": SECRET.encode("utf-16-le"), "utf-16be": SECRET.encode("utf-16-be"), "utf-16": SECRET.encode("utf-16"),
    "utf-16 among others": ("größe 日本 " + SECRET + " é日").encode("utf-16-le"),
    "latin-1": ("größe " + SECRET).encode("latin-1"), "nul": b"a\0bc\0" + SECRET.encode() + b"\0d",
    "esc": b"\x1b[1m" + SECRET.encode() + b"\x1b[0m", "bad byte": b"\xff\xfe\xc3" + SECRET.encode() + b"\x80",
    "looks packed": b"x^2 is a square, " + SECRET.encode(), "nested": b"\xff\0" + b64(SECRET).encode() + b"\xff",
    "escaped": b"\xff\0" + percent(SECRET).encode(), "wide and nested": b64(SECRET).encode("utf-16-le")}


@pytest.mark.parametrize("case", UNCLEAN)
def test_layers_that_are_not_clean_text(case):
    for data in (UNCLEAN[case], gzip.compress(UNCLEAN[case]), gzip.compress(UNCLEAN[case]) + b"\xff tail"):
        text = f"é {b64(data)} z"
        spans = S.scan(text)[1]
        assert any(kind == "assign" and 2 <= a < b <= len(text) - 2 for a, kind, b in spans), data
    text = b64(b"\xff" * 60 + SECRET.encode() + b"\xfe" * 60)
    (a, _, b), = S.scan(text)[1]
    assert 76 <= a <= 80 and b <= len(text) - 76  # placeholders keep the places of the bytes


def test_cut_and_damaged_data():
    long = gzip.compress(SECRET.encode() + random.Random(3).randbytes(100_000).hex("\n").encode())
    for data in (long[:30_000], long[:60_000] + b"\0" * 50 + long[60_050:], long + b"\x1f\x8b\x08 no gzip"):
        for encode in (b64, percent):
            text = encode(data)
            assert (0, "assign", len(text)) in S.scan(text)[1]
    assert S.scan(b64(gzip.compress(b"x") + b" " + SECRET.encode()))[1]


LONG = "filler " * 9 + SECRET + " filler" * 9
BREAKS = {"plain": "\n", "indented": "\n    ", "tabs, crlf": " \r\n\t", "mail": "\n> ", "comment": "\n# ",
          "quoted": '"\n    "', "added": '" +\n    "', "continued": "\\\n", "list": '",\n "'}


@pytest.mark.parametrize("kind", BREAKS)
def test_wrapped_blocks(kind):
    for secret in (LONG.encode(), gzip.compress(LONG.encode()), b"\xff" * 5 + LONG.encode(), LONG.encode("utf-16-le")):
        for encode in (b64, lambda x: base64.urlsafe_b64encode(x).decode()):
            for width in (5, 11, 20, 39, 64, 76):
                run = encode(secret)
                block = BREAKS[kind].join(run[i:i + width] for i in range(0, len(run), width))
                for before, after in (("", ""), ("key: |\n  ", "\nend."), ("some words before\n", "\n\nprose"),
                                      ("word\n", "\nword and more"), ('x = "', '"\n')):
                    text = before + block + after
                    spans = S.scan(text)[1]
                    assert any(kind == "assign" and len(before) <= b and a < len(text) - len(after)
                               for a, kind, b in spans), (width, text)


def test_no_layers_in_garbage():
    names = "internationalization a/long/path/to/some_file_name-with.parts " + hashlib.sha512(b"").hexdigest()[:31]
    assert S.scan(names)[1:] == ([], 0, 0)


def test_a_run_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(S, "MAX_LAYER_BYTES", 1 << 16)
    run = b64("filler " * 20_000 + SECRET + " filler" * 20_000)
    bomb = b64(gzip.compress(f"odd {run}".encode()))
    assert S.scan(bomb)[1] == [(0, "assign", len(bomb))]


def test_layers_of_whole_ranges_and_long_runs_are_cheap():
    run = b64(b"\xff" * 300_000)  # no newline after a long run
    assert S.scan(run + " " + b64(SECRET))[1][0][1] == "assign"
    packed = b64(gzip.compress(b"quiet " * 1_000_000 + SECRET.encode()))
    assert S.scan(packed)[1] == [(0, "assign", len(packed))]


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_query_equals_brute_force(spark):
    docs = table(spark, MEDIUM, "documents")
    got = {r.doc_id: r for r in S.find_secrets(docs).collect()}
    hits = 0
    for r in docs.select("doc_id", "text").collect():
        want = brute(r.text)
        own = got[r.doc_id]
        text = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert own.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (own.n_assign, own.n_access, own.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert set(text.split(",")) <= set(own.spans.split(",")) or not text
        hits += len(want)
    assert hits > 10


def test_case_kelvin_sign_and_long_hex():
    assert S.base_spans("TOKEN: ABCDEFGH") == [(0, "assign", 15)]
    assert S.base_spans("toKen: ABCDEFGH") == []
    assert S.base_spans("z" + "a1" * 16 + "Z") == [(1, "hex", 33)]
    assert S.base_spans("a1" * 15) == []


def test_edge_rows(spark, edge_docs, no_docs):
    got = S.find_secrets(edge_docs).collect()
    assert len(got) == edge_docs.count() and all(r.spans == "" for r in got)
    assert S.find_secrets(no_docs).count() == 0
