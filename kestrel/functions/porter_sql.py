"""Porter stemming as SQL expressions over token arrays: no Python per token.

Every step of the published algorithm is one ``transform`` over the array, so a step is
written once and sees each word as a pair (w, p): the word and its pattern of consonants
(``c``) and vowels (``v``). The measure conditions are then substring tests on ``p``:
m > 0 is ``%vc%``, m > 1 is ``%vc%vc%``. The pattern is computed once: a letter's class
depends on what stands before it, so a cut word has the cut pattern, and the endings that
steps append have no y. The same text is valid in Spark and, with the other array syntax,
in DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from kestrel.functions.porter import STEP2, STEP3, STEP4

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_CLASSES = "".join("v" if c in "aeiou" else "y" if c == "y" else "c" for c in _LETTERS)


@dataclass(frozen=True)
class Dialect:
    """How an engine writes a map over an array, a struct and a fold over letters."""
    over: str
    struct: str
    letters: str

    def map(self, array: str, expr: str) -> str:
        return self.over.format(array=array, expr=expr)

    def pair(self, w: str, p: str) -> str:
        return self.struct.format(w=w, p=p)


SPARK = Dialect("transform({array}, x -> {expr})", "named_struct('w', {w}, 'p', {p})",
                "aggregate(split({p}, ''), '', (a, c) -> {step})")
DUCKDB = Dialect("list_transform({array}, lambda x: {expr})", "{{'w': {w}, 'p': {p}}}",
                 "list_reduce(list_prepend('', string_split({p}, '')), lambda a, c: {step})")


def _pattern(d: Dialect) -> str:
    """Consonants and vowels of ``x``; y is a vowel after a consonant, else a consonant. Where
    no two y meet, one look at the letter before decides; else letter by letter."""
    plain = f"translate(x, '{_LETTERS}', '{_CLASSES}')"
    first = f"CASE WHEN x LIKE 'y%' THEN 'c' || substr({plain}, 2) ELSE {plain} END"
    single = f"replace(replace({first}, 'vy', 'vc'), 'cy', 'cv')"
    step = "concat(a, CASE WHEN c <> 'y' THEN c WHEN a LIKE '%c' THEN 'v' ELSE 'c' END)"
    many = d.letters.format(p=plain, step=step)
    return f"CASE WHEN x LIKE '%yy%' THEN {many} WHEN x LIKE '%y%' THEN {single} ELSE {plain} END"


def _cut(col: str, n: int) -> str:
    return f"left({col}, length(x.w) - {n})"


def _cvc(w: str, p: str) -> str:
    return f"({p} LIKE '%cvc' AND right({w}, 1) NOT IN ('w', 'x', 'y'))"


def _ends(suffix: str) -> str:
    return f"x.w LIKE '%{suffix}'"


def _to(d: Dialect, n: int, ending: str = "") -> str:
    """The pair without its last ``n`` letters and with an ending (no y in it) instead."""
    classes = ending.translate(str.maketrans(_LETTERS, _CLASSES))
    w, p = _cut("x.w", n), _cut("x.p", n)
    return d.pair(f"{w} || '{ending}'", f"{p} || '{classes}'") if ending else d.pair(w, p)


def _table(d: Dialect, rules, condition) -> str:
    """The longest suffix decides, whether its condition holds or not."""
    whens = " ".join(
        f"WHEN {_ends(s)} THEN CASE WHEN {condition(s)} THEN {_to(d, len(s), to)} ELSE x END"
        for s, to in sorted(rules, key=lambda r: -len(r[0])))
    last = ", ".join(f"'{c}'" for c in sorted({s[-1] for s, _ in rules}))
    return f"CASE WHEN right(x.w, 1) NOT IN ({last}) THEN x {whens} ELSE x END"


def _steps(d: Dialect) -> list[str]:
    more, many = "LIKE '%vc%'", "LIKE '%vc%vc%'"
    one = "({p} LIKE '%vc%' AND NOT {p} LIKE '%vc%vc%')"
    bare, bare_p = _cut("x.w", 1), _cut("x.p", 1)
    return [
        # 1a
        f"CASE WHEN {_ends('sses')} OR {_ends('ies')} THEN {_to(d, 2)} "
        f"WHEN {_ends('s')} AND NOT {_ends('ss')} THEN {_to(d, 1)} ELSE x END",
        # 1b; # marks a stem that the next step tidies
        f"CASE WHEN {_ends('eed')} THEN CASE WHEN {_cut('x.p', 3)} {more} THEN {_to(d, 1)} ELSE x END "
        f"WHEN {_ends('ed')} AND {_cut('x.p', 2)} LIKE '%v%' THEN {_to(d, 2, '#')} "
        f"WHEN {_ends('ing')} AND {_cut('x.p', 3)} LIKE '%v%' THEN {_to(d, 3, '#')} ELSE x END",
        f"CASE WHEN NOT {_ends('#')} THEN x "
        f"WHEN {_ends('at#')} OR {_ends('bl#')} OR {_ends('iz#')} THEN {_to(d, 1, 'e')} "
        f"WHEN {bare_p} LIKE '%c' AND length(x.w) > 2 AND substr(x.w, length(x.w) - 1, 1) = substr(x.w, length(x.w) - 2, 1) "
        f"AND substr(x.w, length(x.w) - 1, 1) NOT IN ('l', 's', 'z') THEN {_to(d, 2)} "
        f"WHEN {one.format(p=bare_p)} AND {_cvc(bare, bare_p)} THEN {_to(d, 1, 'e')} ELSE {_to(d, 1)} END",
        # 1c
        f"CASE WHEN {_ends('y')} AND {bare_p} LIKE '%v%' THEN {_to(d, 1, 'i')} ELSE x END",
        _table(d, STEP2, lambda s: f"{_cut('x.p', len(s))} {more}"),
        _table(d, STEP3, lambda s: f"{_cut('x.p', len(s))} {more}"),
        _table(d, [(s, "") for s in STEP4], lambda s: f"{_cut('x.p', len(s))} {many}" + (
            f" AND right({_cut('x.w', 3)}, 1) IN ('s', 't')" if s == "ion" else "")),
        # 5a, 5b
        f"CASE WHEN {_ends('e')} AND ({bare_p} {many} OR {one.format(p=bare_p)} AND NOT {_cvc(bare, bare_p)}) "
        f"THEN {_to(d, 1)} ELSE x END",
        f"CASE WHEN {_ends('ll')} AND x.p {many} THEN {_to(d, 1)} ELSE x END",
    ]


def stems(tokens: str, dialect: Dialect = SPARK) -> str:
    """SQL for the Porter stems of an array of lower-case words (a-z). Words of one or two
    letters are kept: in capitals no rule touches them."""
    short = dialect.pair("upper(x)", "upper(x)")
    out = dialect.map(tokens, f"CASE WHEN length(x) <= 2 THEN {short} ELSE {dialect.pair('x', _pattern(dialect))} END")
    for step in _steps(dialect):
        out = dialect.map(out, step)
    return dialect.map(out, "lower(x.w)")
