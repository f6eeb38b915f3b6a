"""Tags of HTML pages, cut by the states of the HTML standard's tokenizer.

A quote opens a value only behind ``=``; anywhere else ``>`` ends the tag, whatever quotes
stand in it. Every character is looked at a bounded number of times, so an open tag, quote or
comment costs no more than the page is long. As in a browser, a tag that the page's end
cuts off, or whose quoted value never ends, is no tag, and what it took is not shown.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

_BLANK = r"[ \t\n\r\f]"
_MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^ \t\n\r\f/>]*+")
_BETWEEN = re.compile(rf"(?:{_BLANK}|/)*+")
_ATTRIBUTE = re.compile(
    rf"(=?[^ \t\n\r\f/>=]*+)(?:{_BLANK}*+(=){_BLANK}*+(?:\"([^\"]*+)(?:\"|(\Z))|'([^']*+)(?:'|(\Z))"
    r"|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*+)|(?=>)|\Z))?")


class Tag(NamedTuple):
    name: str                # lower case
    end: bool                # an end tag
    attrs: dict[str, str]    # of a name that repeats, the first
    closed: bool             # ends in ``/>``


def read_tag(source: str, at: int) -> tuple[Tag | None, int]:
    """The tag whose name starts at ``at`` (its ``<`` or ``</`` stands before), and the place
    behind it; no tag where the page ends first."""
    name = _NAME.match(source, at)
    end = source[at - 1] == "/"
    attrs: dict[str, str] = {}
    at = name.end()
    while True:
        gap = _BETWEEN.match(source, at)
        at = gap.end()
        if at >= len(source):
            return None, at
        if source[at] == ">":
            return Tag(name[0].lower(), end, attrs, at > gap.start() and source[at - 1] == "/"), at + 1
        m = _ATTRIBUTE.match(source, at)
        if m[4] is not None or m[6] is not None:
            return None, len(source)
        at = m.end()
        value = m[3] or m[5] or m[7] or ""
        attrs.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)


def _behind(source: str, what: str, at: int) -> int:
    i = source.find(what, at)
    return len(source) if i < 0 else i + len(what)


_COMMENT_END = re.compile(r"--!?>")


def tokens(source: str, at: int = 0):
    """(start, end, what) of all markup from ``at`` on: a Tag, the text of a CDATA section,
    or None for comments, declarations and tags that don't end. ``send`` a place to go on
    from there (behind raw text, say)."""
    while (m := _MARKUP.search(source, at)) is not None:
        start, at, what = m.start(), m.end(), None
        sign = source[at]
        if source.startswith("!--", at):
            if source.startswith((">", "->"), at + 3):
                at = _behind(source, ">", at + 3)
            else:
                ended = _COMMENT_END.search(source, at + 3)
                at = ended.end() if ended else len(source)
        elif source.startswith("![CDATA[", at):
            ended = source.find("]]>", at + 8)
            what = source[at + 8:] if ended < 0 else source[at + 8:ended]
            at = len(source) if ended < 0 else ended + 3
        elif sign in "!?":
            at = _behind(source, ">", at)
        elif sign == "/":
            if at + 1 >= len(source):
                return  # a text that ends in "</"
            if _NAME.match(source, at + 1):
                what, at = read_tag(source, at + 1)
            else:
                at = _behind(source, ">", at + 1)
        else:
            what, at = read_tag(source, at)
        moved = yield start, at, what
        if moved is not None:
            at = moved
            yield


def raw_end(source: str, name: str, at: int) -> tuple[int, int]:
    """Where the raw text of an element ends, and the place behind its end tag."""
    m = re.compile(rf"</{re.escape(name)}(?=[ \t\n\r\f/>])", re.IGNORECASE).search(source, at)
    if m is None:
        return len(source), len(source)
    return m.start(), read_tag(source, m.start() + 2)[1]
