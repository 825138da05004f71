"""The base clean (C9) of one text as plain string steps.

It is a pure ``str -> str`` helper of the row-local Arrow UDF behind
``lexis.functions.text.clean_text`` and equals that module's Column steps, chained:
the patterns and tables are theirs, and a step runs only on texts that hold what
it needs.  String methods take a fraction of the time of a dozen regex scans.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.entities import name2codepoint

from lexis.functions import text as tx


def _pattern(java: str) -> re.Pattern:
    """A pattern of ``lexis.functions.text`` in Python's dialect."""
    return re.compile(re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", java.replace(tx.WORD, r"\w")))


URL, MENTION, HASHTAG, EMOTICON, CONTROL, MOJIBAKE = map(_pattern, (
    tx.URL_PATTERN, tx.MENTION_PATTERN, tx.HASHTAG_PATTERN, tx.EMOTICON_PATTERN, tx.CONTROL_CHARS_PATTERN, tx.MOJIBAKE_SEQUENCE))
TRIGGER = _pattern(tx.REPAIR_FIRST)
ENTITY = _pattern("&" + tx.ENTITY.removeprefix("^"))
NAMES = {**{n: chr(p) for n, p in name2codepoint.items()}, "apos": "'"}
BYTES_SHOWN = str.maketrans(tx.CP1252_FROM, tx.CP1252_TO)
SINGLE = dict(zip(tx.SINGLE_FROM, tx.SINGLE_TO))
SINGLE_CLASS = re.compile("[" + re.escape(tx.SINGLE_FROM) + "]")
# Letters, digits and apostrophes stay, every other byte becomes a blank.
KEPT = bytes(b if chr(b).isalnum() or b == 0x27 else 0x20 for b in range(128)) + b" " * 128


@lru_cache(maxsize=1 << 12)
def _sound(garbled: str) -> str:
    return garbled.translate(BYTES_SHOWN).encode("latin-1").decode("utf-8")


def _reference(m: re.Match) -> str:
    ref = m[1]
    if ref[0] != "#":
        return NAMES.get(ref, m[0])
    point = int(ref[2:], 16) if ref[1] in "xX" else int(ref[1:])
    return chr(point) if 1 <= point <= 0x10FFFF and not 0xD800 <= point <= 0xDFFF else "\uFFFD"


def _repaired(s: str) -> str:
    """C2 of a text without control characters."""
    literal = "<" in s or "&" not in s
    if tx.SEAM not in s and not s.isascii():
        for _ in range(tx.GARBLING_LEVELS):
            s, n = MOJIBAKE.subn(lambda m: _sound(m[0]), s)
            if not n:
                break
    if not literal:
        s = ENTITY.sub(_reference, s)
    if not s.isascii():
        for src, dst in tx.LIGATURES:
            s = s.replace(src, dst)
    return s


def clean(s: str) -> str:
    """C2 -> C1 -> lower -> C3 -> C4 -> C5 -> C6 -> C7 -> C8."""
    if not s.isprintable():
        s = CONTROL.sub("", s)
    if "&" in s or not s.isascii():
        if TRIGGER.search(s):
            s = _repaired(s)
        s = SINGLE_CLASS.sub(lambda m: SINGLE[m[0]], s)
    s = s.replace("`", "'").lower()
    if "http" in s or "www." in s:
        s = URL.sub(" ", s)
    if "@" in s or "u/" in s:
        s = MENTION.sub(" ", s)
    if "#" in s:
        s = HASHTAG.sub(r"\1", s)
    if ":" in s or ";" in s or "=" in s:  # astral characters of C6 become blanks below, as by C6
        s = EMOTICON.sub(" ", s)
    return b" ".join(s.encode("ascii", "replace").translate(KEPT).split()).decode()
