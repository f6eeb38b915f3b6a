"""What a page shows: ``display`` and ``visibility`` of its elements.

Read are the ``hidden`` attribute, closed dialogs, ``display`` and ``visibility`` attributes
of drawings, ``style`` attributes, and the rules of ``<style>`` elements whose selectors are
a tag, classes and ids of one element, or lists of such; by importance, origin, specificity and
order. Limits: rules with combinators, pseudo-classes or attribute selectors, rules in
at-rules other than ``@media`` all and screen, linked sheets and scripts are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

# Fixed values of CSS.
DISPLAYED = frozenset(
    "block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell "
    "table-row-group table-header-group table-footer-group table-column table-column-group table-caption "
    "list-item contents flow-root run-in ruby initial inherit unset revert".split())
INHERITED = frozenset("inherit unset revert".split())
#: Rows and row groups: collapsed ones take no place.
COLLAPSING = frozenset("tr tbody thead tfoot col colgroup".split())
#: Elements that keep their place, or their number, when hidden.
PLACED = frozenset("td th li".split())

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_STOP = re.compile(r"[{};]|\"[^\"\n]*+\"?|'[^'\n]*+'?|\([^(){}]*+\)")
_COMPOUND = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.IGNORECASE)
_SCREEN = re.compile(r"@media\s+(?:only\s+)?(?:all|screen)(?:\s*,.*)?", re.IGNORECASE | re.DOTALL)

Values = dict[str, tuple[tuple, str]]  # property -> (precedence, value)


def _declared(own: Values, declaration: str, origin: tuple) -> None:
    """Take a declaration into ``own`` if it is valid and nothing stronger stands there."""
    name, _, value = declaration.partition(":")
    name = name.strip().lower()
    if name not in ("display", "visibility"):
        return
    value, bang, rest = value.strip().lower().partition("!")
    if bang and rest.strip() != "important":
        return
    words = value.split()
    if name == "display":
        if not words or not (words == ["none"] or all(w in DISPLAYED for w in words)):
            return
    elif len(words) != 1 or words[0] not in INHERITED | {"visible", "hidden", "collapse", "initial"}:
        return
    at = (bool(bang), *origin)
    if name not in own or own[name][0] <= at:
        own[name] = at, words[0]


def _pieces(css: str) -> Iterator[tuple[str, str]]:
    """The parts of a sheet between ``{``, ``}`` and ``;``, each with what ended it."""
    start = 0
    for m in _STOP.finditer(css):
        if m[0] in "{};":
            yield css[start:m.start()], m[0]
            start = m.end()
    yield css[start:], ""


class Rules:
    """The rules of a page's sheets, found by an id, class or tag of their selectors."""

    def __init__(self):
        self.by: dict[str, dict[tuple, Values]] = {}
        self.order = 0

    def add(self, css: str) -> None:
        """Rules of one sheet, which come after all that were added before."""
        open_: list = []  # per open block: whether an at-rule applies, or a rule's values
        for piece, stop in _pieces(_COMMENT.sub(" ", css.replace("<!--", " ").replace("-->", " "))):
            inside = open_ and open_[-1]
            if isinstance(inside, tuple):
                selectors, declarations = inside
                if stop != "{":
                    declarations.append(piece)
            if stop == "{":
                head = piece.strip()
                reads = all(o is True for o in open_)
                if head.startswith("@") or not reads:
                    open_.append(reads and bool(_SCREEN.fullmatch(head)))
                else:
                    open_.append((head, []))
            elif stop in ("}", "") and open_:
                if isinstance(open_.pop(), tuple):
                    self._rule(selectors, declarations)

    def _rule(self, selectors: str, declarations: list[str]) -> None:
        self.order += 1
        if not any("display" in d.lower() or "visibility" in d.lower() for d in declarations):
            return
        compounds = [_COMPOUND.fullmatch(s.strip()) for s in selectors.split(",")]
        for m in compounds:
            if m is None or not m[0]:
                continue
            names = re.findall(r"[.#][\w-]+", m[2])
            tag = (m[1] or "*").lower()
            ids = frozenset(n[1:] for n in names if n[0] == "#")
            classes = frozenset(n[1:] for n in names if n[0] == ".")
            weight = (len(ids), len(classes), int(tag != "*"))
            key = max(("#" + i for i in ids), default=max(("." + c for c in classes), default=tag))
            own = self.by.setdefault(key, {}).setdefault((tag, ids, classes), {})
            for d in declarations:
                _declared(own, d, (0, weight, self.order))

    def values(self, node) -> Values:
        """Of an element: what its style says and what the rules say, the stronger ones."""
        out: Values = {}
        a = node.attrs
        if self.by:
            classes = frozenset(a.get("class", "").split()) if "class" in a else frozenset()
            own_id = a.get("id")
            for key in ("*", node.tag, f"#{own_id}", *("." + c for c in classes)):
                for (tag, ids, wanted), own in self.by.get(key, {}).items():
                    if tag in ("*", node.tag) and ids <= {own_id} and wanted <= classes:
                        for name, value in own.items():
                            if name not in out or out[name][0] <= value[0]:
                                out[name] = value
        if "style" in a:
            for i, (piece, _) in enumerate(_pieces(_COMMENT.sub(" ", a["style"]))):
                _declared(out, piece, (1, (0, 0, 0), i))
        return out


def _state(node, rules: Rules) -> tuple[bool, str | None]:
    """Whether an element is displayed, and its own visibility if it has one."""
    a = node.attrs
    if not a and not rules.by:
        return node.tag != "dialog", None
    said = rules.values(node)
    display, visibility = said.get("display"), said.get("visibility")
    if display:
        displayed = display[1] != "none"
    else:
        displayed = not ("hidden" in a and a["hidden"].lower() != "until-found"
                         or node.tag == "dialog" and "open" not in a
                         or node.foreign and a.get("display", "").strip() == "none")
    own = visibility[1] if visibility else a.get("visibility", "").strip() or None if node.foreign else None
    return displayed, None if own in INHERITED else "visible" if own == "initial" else own


def keep_visible(root, rules: Rules, unseen: frozenset) -> None:
    """Leave in the tree what shows: elements that are displayed and, of hidden ones, the
    visible elements inside. Hidden cells and list items stay as empty ones; ``unseen`` tags
    show nothing. An explicit stack: no nesting is too deep."""
    frames = [(root, True, iter(root.children), [])]
    while True:
        node, shown, rest, kept = frames[-1]
        child = next(rest, None)
        if child is None:
            frames.pop()
            node.children = kept
            node.hidden = not shown
            if not frames:
                return
            if shown or kept or node.tag in PLACED:
                frames[-1][3].append(node)
        elif isinstance(child, str):
            if shown:
                kept.append(child)
        elif child.tag not in unseen:
            displayed, own = _state(child, rules)
            if not displayed or own == "collapse" and child.tag in COLLAPSING \
                    or child.tag == "input" and child.attrs.get("type", "").lower() == "hidden":
                continue
            visible = shown if own is None else own == "visible"
            frames.append((child, visible, iter(child.children), []))
