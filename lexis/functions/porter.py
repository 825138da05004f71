"""Porter suffix-stripping stemmer (M. F. Porter, "An algorithm for suffix
stripping", Program 14(3), 1980) with the common extensions used by the
reference's stemmer: an irregular-form table, short words left alone, the
``ies``/``ied`` length rule and the extra step-2 suffixes.

It is a pure ``str -> str`` helper of the stemming variant's row-local Arrow
UDF, which keeps the stems it has seen (see ``lexis.operators.clean``).
"""

from __future__ import annotations

from functools import lru_cache

# Irregular forms mapped directly to their stem.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

_VOWELS = set("aeiou")


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_cons(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) >= 3:
        return (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
                and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")
    return len(w) == 2 and not _is_cons(w, 0) and _is_cons(w, 1)


def _apply_rules(w: str, rules, min_m: int) -> str:
    for suffix, repl in rules:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            if suffix == "ion":
                return stem if _measure(stem) > min_m and stem[-1:] in ("s", "t") else w
            return stem + repl if _measure(stem) > min_m else w
    return w


def _step2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step2(w[:-2])
    if w.endswith("logi"):  # the l counts with the stem
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _apply_rules(w, _STEP2, 0)


_STEP2 = sorted([
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
], key=lambda r: -len(r[0]))
_STEP3 = sorted([
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
], key=lambda r: -len(r[0]))
_STEP4 = sorted([(s, "") for s in (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")], key=lambda r: -len(r[0]))


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    w = word.lower()
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("ied"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and len(w) > 2 and _is_cons(w, len(w) - 2):
        w = w[:-1] + "i"
    # steps 2-4
    w = _step2(w)
    w = _apply_rules(w, _STEP3, 0)
    w = _apply_rules(w, _STEP4, 1)
    # step 5a
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    # step 5b
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w
