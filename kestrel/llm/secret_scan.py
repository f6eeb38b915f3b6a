"""Secret scans with a recursive decoding worklist.

Every text is scanned as it stands. Then a worklist unwraps what may hide a secret:
percent-encoding, Unicode escapes, base64 runs and compressed bytes. Each decoded layer is
scanned again and goes back on the worklist until nothing new decodes. Every character of
a layer knows the range of the original text it came from, so a secret found three layers
down is reported as a span of the document. A layer that repeats one of its ancestors ends
its branch (a compressed quine would otherwise go on for ever).
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

MAX_LAYER_BYTES = 64 << 20  # a layer that unpacks to more is counted and scanned as a stream
MAX_STREAM_BYTES = 16 << 30  # of a stream; one that goes on is counted once more
MAX_STREAM_DEPTH = 64       # compressed streams within one another
CHUNK = 1 << 16
MIN_BASE64 = 16

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
# A maximal run of 32 or more: the same spans as the greedy run with the short ones dropped.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_ESCAPES = re.compile(f"(?:{_ESCAPE.pattern})+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
# Lines of base64 of any length, indented or quoted. Possessive: a long run is read once.
_BREAK = re.compile(r"""(?:["'][ \t]*+[+,\\]?|[ \t]++[+\\]|[,\\])?[ \t]*+(?:\r\n|\n|\r)[ \t>|#*]*+["']?""")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:%s[A-Za-z0-9+/_-]++)+={0,2}" % _BREAK.pattern)
_BASE64_PART = re.compile(r"[A-Za-z0-9]{%d,}={0,2}" % MIN_BASE64)
# First bytes of the compressed formats (fixed values): gzip, zlib, bzip2, xz, zstd and its
# frames to skip.
# ASCII as UTF-16 of either byte order (the last character of the one has no zero behind it).
_WIDE = re.compile(r"\x00?(?:[\x01-\x7f]\x00){4,}")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_NO_TEXT = re.compile(r"[\udc80-\udcff]")  # bytes that are not UTF-8
# What a layer has that can be decoded further.
_WORTH = re.compile(r"%%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{%d}|(?:[\x01-\x7f]\x00){4}"
                    r"|[A-Za-z0-9+/_-]%s[A-Za-z0-9+/_-]" % (MIN_BASE64, _BREAK.pattern))
_BLANKS = re.compile(r"\x20{3,}")
_RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_ENCODED = _RUN + "= \t\r\n>|*\"',%\\&#;{}\0"  # what encoded data of any kind is written in
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|[\x50-\x5f]\x2a\x4d\x18")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the secrets that stand in the text itself."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)
                  if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return in_order(found)


def in_order(spans) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


class Layer:
    """A decoded text and, per character, the range of the root text it came from.
    ``starts`` is None for the root, where character i is the range (i, i + 1). It is a
    number where every character came from the one range (starts, ends)."""

    def __init__(self, text: str, starts, ends, ancestors: frozenset, digest: bytes = b""):
        self.text, self.starts, self.ends = text, starts, ends
        self.ancestors, self.digest = ancestors, digest
        self.whole = isinstance(starts, int)
        self.doubtful = False  # may be no text at all

    def root(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if self.whole:
            return self.starts, self.ends
        return min(self.starts[start:end]), max(self.ends[start:end])

    def child(self, text: str, pieces) -> Layer | None:
        """``pieces``: per character of ``text`` its range in this layer, or the one range
        of all of them. None if the text is one of its own ancestors."""
        digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if digest in self.ancestors or not text:
            return None
        if self.whole or isinstance(pieces, tuple):
            a, b = self.root(*pieces) if isinstance(pieces, tuple) else (self.starts, self.ends)
            return Layer(text, a, b, self.ancestors | {digest}, digest)
        own = [self.root(a, b) for a, b in pieces]
        return Layer(text, [a for a, _ in own], [b for _, b in own], self.ancestors | {digest}, digest)


class Stream:
    """A range of a layer whose content is too large for a layer. As all of it maps to that
    range, it is scanned in overlapping pieces, one at a time."""

    def __init__(self, layer: Layer, start: int, end: int, data: bytes):
        self.layer, self.range, self.data, self.cut = layer, (start, end), data, False

    def _texts(self) -> Iterator[str]:
        decode, size = codecs.getincrementaldecoder("utf-8")("surrogateescape").decode, 0
        for chunk in _opened(_chunks(self.data)):
            if size >= MAX_STREAM_BYTES:
                self.cut = True
                break
            size += len(chunk)
            yield decode(chunk)
        yield decode(b"", True)

    def layers(self) -> Iterator[Layer | None]:
        for piece in _pieces(self._texts()):
            yield self.layer.child(piece, self.range)


def _pieces(texts: Iterable[str]) -> Iterator[str]:
    """A long text in pieces. A piece begins where the encoded run that the last one cut
    begins, and at least an overlap before its end; only a run longer than a piece is
    parted, at a line or at a multiple of four characters, where base64 can be parted."""
    size, overlap = max(64, MAX_LAYER_BYTES // 4), max(16, MAX_LAYER_BYTES // 64)
    held, due = [], 0
    for text in texts:
        held.append(text)
        due += len(text)
        if due < size:
            continue
        whole = _BLANKS.sub("  ", "".join(held))  # no pattern counts blanks
        while len(whole) >= size:
            yield whole[:size]
            at = size - overlap
            start = min(at, len(whole[:size].rstrip(_ENCODED)))
            if start < overlap:
                start = whole.rfind("\n", overlap, at) + 1
            if not start:
                run = len(whole[:at].rstrip(_RUN))
                start = run + (at - run) // 4 * 4
            whole = whole[start:]
        held, due = [whole], len(whole)
    if due:
        yield "".join(held)


def _chunks(data: bytes) -> Iterator[bytes]:
    return (data[i:i + CHUNK] for i in range(0, len(data), CHUNK))


def _decompressor(head: bytes):
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(47)
    if head[:1] == b"\x78":
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:1] == b"\xfd":
        return lzma.LZMADecompressor()
    return zstandard.ZstdDecompressor().decompressobj()


_BROKEN = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError)


def _output(d, data: bytes) -> Iterator[bytes]:
    """What a decompressor makes of some more input, in small parts; returns the bytes that
    stand behind its end."""
    if isinstance(d, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
        yield d.decompress(data, CHUNK)
        while not d.eof and not d.needs_input:
            yield d.decompress(b"", CHUNK)
    elif type(d).__module__ == "zlib":
        yield d.decompress(data, CHUNK)
        while d.unconsumed_tail and not d.eof:
            yield d.decompress(d.unconsumed_tail, CHUNK)
    else:  # zstd has no bound on its output
        for i in range(0, len(data), 1024):
            yield d.decompress(data[i:i + 1024])
            if d.eof:
                return d.unused_data + data[i + 1024:]
    return d.unused_data if d.eof else b""


def _unpacking(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of compressed data, as it comes: of all members or frames, also of
    different formats, with or without zeros between them, and what stands behind as it is.
    Returns whether all of it was whole."""
    chunks, d, rest, first = iter(chunks), None, b"", True
    while True:
        if d is None:
            while len(rest) < 8 and (more := next(chunks, None)) is not None:
                rest = (rest + more).lstrip(b"\0")
            if not _MAGIC.match(rest):
                yield rest
                yield from chunks
                return True
            d = _decompressor(rest)
        try:
            rest = yield from _output(d, rest)
        except _BROKEN:
            if first:
                raise
            yield rest
            yield from chunks
            return False
        if d.eof:
            d, first = None, False
            rest = rest.lstrip(b"\0")
        elif not (rest := next(chunks, b"")):
            if type(d).__module__ == "zlib":
                yield d.flush()
            return False


def _opened(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of compressed data through all layers of compression."""
    for _ in range(MAX_STREAM_DEPTH):
        head = b""
        while len(head) < CHUNK and (more := next(chunks, None)) is not None:
            head += more
        try:
            if packed := _MAGIC.match(head) is not None:
                any(_unpacking([head]))  # breaks at once if they only look so
        except _BROKEN:
            packed = False
        chunks = itertools.chain([head], chunks)
        if not packed:
            break
        chunks = _unbroken(_unpacking(chunks))
    return chunks


def _unbroken(chunks: Iterator[bytes]) -> Iterator[bytes]:
    try:
        yield from chunks
    except _BROKEN:
        return  # what came before the damage stands


def unpacked(data: bytes) -> tuple[bytes, bool] | None:
    """The content of compressed bytes and whether it is whole; None if they aren't.
    OverflowError beyond the bound."""
    if not _MAGIC.match(data):
        return None
    out, size, whole, parts = [], 0, False, _unpacking(_chunks(data))
    try:
        while True:
            out.append(next(parts))
            size += len(out[-1])
            if size > MAX_LAYER_BYTES:
                raise OverflowError(data)
    except StopIteration as end:
        whole = end.value
    except _BROKEN:
        pass
    return (b"".join(out), whole) if whole or size else None


def _contents(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Decoded bytes, unpacked through any compressed layers; and whether they were packed
    (their characters then map to the whole region). Bytes that do not unpack to the end
    stand for themselves too: they may only look packed. OverflowError has the bytes whose
    content is beyond the bound."""
    packed = False
    while (got := unpacked(data)) is not None and got[0] != data:
        if not got[1]:
            yield data, packed
        data, packed = got[0], True
    yield data, packed


def _readable(data: bytes, packed: bool) -> tuple[str, bool] | None:
    """The bytes as text, with placeholders for bytes that are not UTF-8, and whether it may
    be no text at all (then None if nothing in it can be found or decoded)."""
    text = data.decode("utf-8", "surrogateescape")
    doubtful = bool(_NO_TEXT.search(text) or not packed and _CONTROL.search(text))
    if not text or doubtful and not _WORTH.search(text) and not base_spans(text):
        return None
    return text, doubtful


def _whole_ranges(layer: Layer, start: int, end: int, data: bytes) -> Iterator[Layer | Stream | None]:
    """Layers of the unpacked contents of a range's bytes."""
    try:
        for content, packed in _contents(data):
            if packed and (got := _readable(content, packed)):
                yield _marked(layer.child(got[0], (start, end)), got[1])
    except OverflowError as e:
        yield Stream(layer, start, end, e.args[0])


def _is_packed(data: bytes) -> bool:
    """Whether the bytes surely are compressed data: they do unpack to their end."""
    try:
        got = unpacked(data)
    except OverflowError:
        return True
    return got is not None and got[1] and got[0] != data


def _marked(layer: Layer | None, doubtful: bool) -> Layer | None:
    if layer is not None:
        layer.doubtful = doubtful
    return layer


def _substituted(layer: Layer, pattern, decode, as_bytes=None) -> Iterator[Layer | Stream | None]:
    """The whole layer with every match of an escape replaced by what it stands for.
    Compressed bytes that the escapes spell out come as layers of their own if they are too
    large to stand there, or may not be compressed."""
    text, pieces, at, changed = [], [], 0, False
    for m in pattern.finditer(layer.text):
        got, data = None, as_bytes(m) if as_bytes else None
        if data and _MAGIC.match(data):
            try:
                (content, packed), *others = _contents(data)
                if packed and not others:
                    got = [(content.decode("utf-8", "surrogateescape"), 0, len(m[0]))]
            except OverflowError:
                others = True
            if others:
                yield from _whole_ranges(layer, m.start(), m.end(), data)
                if _is_packed(data):
                    continue
        got = got or decode(m)
        text.append(layer.text[at:m.start()])
        if not layer.whole:
            pieces += [(i, i + 1) for i in range(at, m.start())]
        for s, a, b in got:
            text.append(s)
            if not layer.whole:
                pieces += [(m.start() + a, m.start() + b)] * len(s)
        at, changed = m.end(), True
    if changed:
        text.append(layer.text[at:])
        if not layer.whole:
            pieces += [(i, i + 1) for i in range(at, len(layer.text))]
        yield layer.child("".join(text), pieces)


def _percent_bytes(m) -> bytes:
    return bytes.fromhex(m[0].replace("%", ""))


def _percent(m) -> list:
    data = _percent_bytes(m)
    out, at = [], 0
    while at < len(data):  # by UTF-8 character; a byte that is none stays as it is
        for n in (1, 2, 3, 4):
            try:
                out.append((data[at:at + n].decode("utf-8"), 3 * at, 3 * (at + n)))
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out += [(c, 3 * at + i, 3 * at + i + 1) for i, c in enumerate(m[0][3 * at:3 * at + 3])]
        at += n
    return out


def _escapes(m) -> list:
    """A run of escapes: one character each."""
    out = []
    for e in _ESCAPE.finditer(m[0]):
        digits = next(g for g in e.groups() if g)
        code = int(digits, 10 if e[6] else 16)
        known = code < 0x110000 and not 0xD800 <= code < 0xE000
        out.append((chr(code) if known else e[0], e.start(), e.end()))
    return out


def _escapes_bytes(m) -> bytes | None:
    """The bytes that a run of escapes spells out, if it does."""
    chars = [c for c, _, _ in _escapes(m)]
    if all(len(c) == 1 and c < "\u0100" for c in chars):
        return "".join(chars).encode("latin-1")
    return None


def _narrow(m) -> list:
    lead = m[0][0] == "\0"
    return [(m[0][i], i, i + 2) for i in range(lead, len(m[0]), 2)]


def _decoded_run(layer: Layer, lines: list[tuple[int, int]]) -> Iterator[Layer | Stream | None]:
    """Layers of the base64 that stands in these ranges, one behind another."""
    start, end = lines[0][0], lines[-1][1]
    body = "".join([layer.text[a:b] for a, b in lines]).rstrip("=")
    raw = body[:len(body) - (len(body) % 4 == 1)].replace("-", "+").replace("_", "/")
    try:
        data = base64.b64decode(raw + "=" * (-len(raw) % 4), validate=True)
    except ValueError:
        return
    if _MAGIC.match(data):
        yield from _whole_ranges(layer, start, end, data)
        if _is_packed(data):
            return
    readable = _readable(data, False)
    if readable is None:
        return
    text, doubtful = readable
    if layer.whole:
        yield _marked(layer.child(text, (start, end)), doubtful)
        return
    at = [i for a, b in lines for i in range(a, b)]
    pieces, byte = [], 0
    for c in text:  # three bytes stand in four characters
        n = 1 if c < "\x80" else len(c.encode("utf-8", "surrogateescape"))
        last = min(len(at), ((byte + n - 1) // 3 + 1) * 4) - 1
        pieces.append((at[byte // 3 * 4], at[last] + 1))
        byte += n
    yield _marked(layer.child(text, pieces), doubtful)


def _wrapped_lines(text: str, m) -> Iterator[list[tuple[int, int]]]:
    """The lines of a wrapped block from where its base64 may begin. Words on the lines
    before it only shift its phase, of which there are four; compressed data begins at a
    line of its own."""
    lines, at = [], m.start()
    for gap in _BREAK.finditer(text, m.start(), m.end()):
        lines.append((at, gap.start()))
        at = gap.end()
    lines.append((at, m.end()))
    body = "".join([text[a:b] for a, b in lines]).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) < MIN_BASE64:
        return
    phases, chars = set(), 0
    for i, (a, b) in enumerate(lines):
        if chars % 4 not in phases or _begins_packed(body[chars:chars + 256]):
            phases.add(chars % 4)
            yield lines[i:]
        chars += b - a


def _begins_packed(body: str) -> bool:
    data = base64.b64decode(body[:len(body) // 4 * 4])
    try:
        return bool(_MAGIC.match(data)) and (any(_unpacking([data])) or True)
    except _BROKEN:
        return False


def children(layer: Layer) -> Iterator[Layer | Stream | None]:
    """Every layer that one step of decoding gives."""
    text = layer.text
    if "%" in text:
        yield from _substituted(layer, _PERCENT, _percent, _percent_bytes)
    if "\\" in text or "&#" in text:
        yield from _substituted(layer, _ESCAPES, _escapes, _escapes_bytes)
    if "\0" in text:
        yield from _substituted(layer, _WIDE, _narrow)
    for m in _WRAPPED.finditer(text):
        for lines in _wrapped_lines(text, m):
            yield from _decoded_run(layer, lines)
    for m in _BASE64.finditer(text):
        clean = False
        for got in _decoded_run(layer, [m.span()]):
            clean = clean or isinstance(got, Stream) or got is not None and not got.doubtful
            yield got
        if not clean and any(c in m[0] for c in "+/_-"):  # a path or a joined name
            for part in _BASE64_PART.finditer(m[0]):
                yield from _decoded_run(layer, [(m.start() + part.start(), m.start() + part.end())])


def scan(text: str | None) -> tuple[list, list, int, int]:
    """(base spans, all spans, decoded layers, layers over the bound) of one text."""
    text = text or ""
    base = base_spans(text)
    spans, layers, packed = set(base), 0, 0
    # The worklist holds what is left to decode of each open layer; the newest goes on.
    seen, work, streams = set(), [children(Layer(text, None, None, frozenset()))], []
    while work:
        got = next(work[-1], False)
        if got is False:
            work.pop()
        elif isinstance(got, Stream):
            packed += 1
            streams.append(got)
            work.append(got.layers())
        elif got is not None:
            key = (got.digest, got.root(0, 1)[0], got.root(len(got.text) - 1, len(got.text))[1])
            if key in seen:
                continue
            seen.add(key)
            found = base_spans(got.text)
            layers += bool(found) or not got.doubtful
            for start, kind, end in found:
                a, b = got.root(start, end)
                spans.add((a, kind, b))
            work.append(children(got))
    return base, in_order(spans), layers, packed + sum(s.cut for s in streams)


SCHEMA = ("doc_id {id}, n_assign long, n_access long, n_hex long, base_sha256 string, "
          "spans string, n_layers long, n_packed long")


def scan_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            base, spans, layers, packed = scan(text)
            kinds = [kind for _, kind, _ in base]
            rows.append((doc_id, *(kinds.count(k) for k in KINDS),
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                         layers, packed))
        yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex",
                                          "base_sha256", "spans", "n_layers", "n_packed"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and digest of the spans in the text itself, and all
    spans with those found in decoded layers, as ranges of the text in code points.

    Null and empty texts have no spans (digest of the empty string). Every row is scanned
    by itself, whole, without a shuffle; repeated rows give repeated results, a null id
    stays null, other columns are ignored, an empty table gives no rows.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = ids.withColumn("doc_id", F.col("doc_id").cast("string"))
    kind = docs.schema[id_col].dataType.simpleString()
    found = ids.mapInPandas(scan_batches, SCHEMA.format(id="string"))
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
