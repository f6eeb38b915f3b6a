"""Porter's suffix-stripping algorithm (M.F. Porter, 1980, Program 14(3) 130-137).

The rule tables, and a per-word function against which the tests hold the column form
of the algorithm (``kestrel.functions.porter_sql``). No Spark job calls it.
"""

from __future__ import annotations

from functools import lru_cache


def _consonant(w: str, i: int) -> bool:
    c = w[i]
    if c in "aeiou":
        return False
    if c == "y":
        return i == 0 or not _consonant(w, i - 1)
    return True


def measure(stem: str) -> int:
    """m in the form [C](VC)^m[V]: the number of vowel-to-consonant transitions."""
    m, after_vowel = 0, False
    for i in range(len(stem)):
        cons = _consonant(stem, i)
        if cons and after_vowel:
            m += 1
        after_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _consonant(stem, i) for i in range(len(stem)))


def _double_consonant(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    """Ends consonant-vowel-consonant, the last consonant not w, x or y."""
    return (len(w) >= 3 and _consonant(w, len(w) - 3) and not _consonant(w, len(w) - 2)
            and _consonant(w, len(w) - 1) and w[-1] not in "wxy")


# The suffix rules of steps 2, 3 and 4 of the published algorithm.
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
         ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
         ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
         ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
         ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _longest(w: str, suffixes):
    best = None
    for s in suffixes:
        if w.endswith(s) and (best is None or len(s) > len(best)):
            best = s
    return best


def _rule_step(w: str, rules, min_m: int) -> str:
    table = dict(rules)
    s = _longest(w, table)
    if s is not None and measure(w[:-len(s)]) > min_m:
        return w[:-len(s)] + table[s]
    return w


def _step4(w: str) -> str:
    s = _longest(w, STEP4)
    if s is None:
        return w
    stem = w[:-len(s)]
    if measure(stem) > 1 and (s != "ion" or stem[-1:] in ("s", "t")):
        return stem
    return w


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    """Stem one lower-case word; words of one or two letters are kept."""
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    # step 1b
    tidy = False
    if w.endswith("eed"):
        if measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, tidy = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, tidy = w[:-3], True
    if tidy:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_consonant(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _rule_step(w, STEP2, 0)
    w = _rule_step(w, STEP3, 0)
    w = _step4(w)
    # step 5a
    if w.endswith("e"):
        m = measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    # step 5b
    if w.endswith("ll") and measure(w) > 1:
        w = w[:-1]
    return w
