"""Text-cleaning steps as native Spark Column expressions.

Every step is a ``Column -> Column`` function built from ``translate``,
``replace`` and ``regexp_replace``.  The whole chain, ``clean_text``, is one
row-local Arrow UDF: a dozen regex scans per text cost several times as much.

Regex dialect: Spark evaluates Java regexes, the DuckDB oracle RE2.  Both read
the patterns below identically because every class is spelled out:
``\\w`` (Unicode in the reference) becomes ``[\\p{L}\\p{N}_]`` and ``\\s``
becomes the Unicode whitespace class ``WS``.
"""

from __future__ import annotations

from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's cleaning behaviour.
# ---------------------------------------------------------------------------
# C1 quote normalisation: four single marks become ', five double marks become ".
SINGLE_QUOTES = "’‘`´"
DOUBLE_QUOTES = "“”„«»"
# C3 URLs, C4 mentions, C5 hashtags, C6 astral characters and ASCII emoticons,
# C7 allowed characters, C8 whitespace runs, C15 mojibake marker characters.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"[\p{L}\p{N}_]"
URL_PATTERN = rf"https?://[^{WS}]+|www\.[^{WS}]+"
MENTION_PATTERN = rf"@{WORD}+|u/{WORD}+"
HASHTAG_PATTERN = rf"#[{WS}]*({WORD}+)"
ASTRAL_PATTERN = r"[\x{10000}-\x{10ffff}]"
EMOTICON_PATTERN = r"[:;=]['\-]?[)(D/\\|PpOo]"
SPECIAL_PATTERN = rf"[^a-zA-Z0-9{WS}']"
SPACES_PATTERN = rf"[{WS}]+"
# The characters of ``SPECIAL_PATTERN`` spelled out: Java scans a plain class several times faster than a negated one.
_NOT_WORD = r"\x21-\x26\x28-\x2F\x3A-\x40\x5B-\x60"
SPECIAL_CLASS = (rf"[\x00-\x08\x0E-\x1B{_NOT_WORD}\x7B-\x{{84}}\x{{86}}-\x{{9F}}\x{{A1}}-\x{{167F}}\x{{1681}}-\x{{1FFF}}\x{{200B}}-\x{{2027}}"
                 r"\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]")
# C7 and C8 in one scan: what C7 removes and white space, in runs.
SPECIAL_OR_SPACE_RUN = rf"[\x00-\x20{_NOT_WORD}\x7B-\x{{10FFFF}}]+"
MOJIBAKE_PATTERN = r"[â€™œžŸšŠ¢�ÃÂ]|[\x{80}-\x{9F}]"
# C18 profiling tokeniser and C19 vectoriser tokeniser (>= 2 word characters).
ALPHA_TOKEN_PATTERN = r"[a-z]+"
WORD_TOKEN_PATTERN = r"\b\w\w+\b"
ASCII_WORD_TOKEN_PATTERN = "[a-z0-9_]{2,}"

# C2 repair subset: the encoding repairs whose effect survives C7 (everything
# non-ASCII becomes a space there), applied before C1.
CONTROL_CHARS_PATTERN = r"[\x00-\x08\x0E-\x1F\x7F]"
# Mojibake: UTF-8 bytes read as Latin-1 or cp1252.  cp1252 shows the bytes 80-9F
# as other characters (five it leaves as they are); a garbled character is a lead
# byte and its continuation bytes in either form.  Leads are those of Latin, Greek
# and Cyrillic letters, of punctuation and symbols (E2 80-84), of full-width forms,
# ligatures and the byte order mark (EF AC, BB-BD) and of emoji (F0 9F): others
# start sequences that sound text may hold, such as a grave a, a blank and a mark.
GARBLING_LEVELS = 3
CP1252_SHOWN = {bytes([b]).decode("cp1252", "ignore"): chr(b) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")}
CP1252_FROM, CP1252_TO = "".join(CP1252_SHOWN), "".join(CP1252_SHOWN.values())
_CONTINUED = "[\\x{80}-\\x{BF}" + CP1252_FROM + "]"
MOJIBAKE_SEQUENCE = (f"[\u00c2-\u00c5\u00ce-\u00d1]{_CONTINUED}|\u00e2[\\x{{80}}-\\x{{84}}\u20ac\u201a\u0192\u201e]{_CONTINUED}|"
                     f"\u00ef[\u00ac\u00bb-\u00bd]{_CONTINUED}|\u00f0[\\x{{9F}}\u0178]{_CONTINUED}{{2}}|"
                     "\u00c6[\\x{92}\u2019]|\u00cb[\\x{86}\\x{9C}\u2020\u0153]")  # C6 92, CB 86 and CB 9C: letters that cp1252 shows
SEAM = "\ue000"  # private use: marks where garbled characters begin and end
# C1 control characters read as cp1252 quotes.
C1_SINGLE_QUOTES, C1_DOUBLE_QUOTES = "\u0091\u0092", "\u0093\u0094"
REFERENCE = "&#?[A-Za-z0-9]+;"
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
LIGATURES = [("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"),
             ("ﬅ", "st"), ("ﬆ", "st"), ("Ĳ", "IJ"), ("ĳ", "ij")]
LIGATURE_CLASS = "[\uFB00-\uFB06\u0132\u0133]"
# Full-width forms U+FF01..U+FF5E map by rule onto ASCII U+0021..U+007E.
FULLWIDTH_FROM = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
FULLWIDTH_TO = "".join(chr(0x21 + i) for i in range(94)) + " "
# The multi-character repairs can only match when one of these characters occurs.
REPAIR_TRIGGER = "[&\uFB00-\uFB06\u0132\u0133]|" + MOJIBAKE_SEQUENCE
# One of these is the first character of every match of the trigger; one class scans faster.
REPAIR_FIRST = "[&\uFB00-\uFB06\u0132\u0133\u00c2-\u00c6\u00cb\u00ce-\u00d1\u00e2\u00ef\u00f0]"
# The trigger behind a look at its first character: other characters fail one class instead of every branch.
REPAIR_SCAN = f"(?={REPAIR_FIRST})(?:{REPAIR_TRIGGER})"
MOJIBAKE_SCAN = f"(?=[\u00c2-\u00c6\u00cb\u00ce-\u00d1\u00e2\u00ef\u00f0])(?:{MOJIBAKE_SEQUENCE})"
# Garbled characters, of any level, lie inside runs of characters beyond ASCII.
BEYOND_ASCII_RUN = r"([^\x00-\x7F]{2,})"
# C3 to C5 and C6 can only match in texts with one of these (or ``www.``).
MARK_FIRST, EMOJI_FIRST = "[@#/]", r"[:;=\x{10000}-\x{10ffff}]"


def _single_char_map() -> tuple[str, str]:
    """One translate table = full-width folding followed by quote normalisation
    (composed per character, so U+FF40 goes straight to an apostrophe)."""
    quote = {**{q: "'" for q in SINGLE_QUOTES + C1_SINGLE_QUOTES}, **{q: '"' for q in DOUBLE_QUOTES + C1_DOUBLE_QUOTES}}
    table = {f: quote.get(t, t) for f, t in zip(FULLWIDTH_FROM, FULLWIDTH_TO)}
    table.update(quote)
    return "".join(table), "".join(table.values())


SINGLE_FROM, SINGLE_TO = _single_char_map()
# Texts without one of these characters pass C2 and C1 unchanged; most texts fail the first, small class already.
NOT_PLAIN = r"[\x00-\x08\x0E-\x1F&`\x7F-\x{10FFFF}]"
REPAIR_OR_MAP = (rf"[\x00-\x08\x0E-\x1F&`\x7F\x91-\x94\xAB\xB4\xBB{REPAIR_FIRST[2:-1]}"
                 r"\x{2018}-\x{201E}\x{3000}\x{FF01}-\x{FF5E}]")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _re(c: Column, pattern: str, repl: str = " ") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(repl))


def _once(c: Column, step) -> Column:
    """``step`` of ``c``, which is computed once a row however often ``step`` names it."""
    return F.get(F.transform(F.array(c), step), 0)


def _replace_all(c: Column, pairs) -> Column:
    for src, dst in pairs:
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def normalize_quotes(c) -> Column:
    """curly/typographic quotes and apostrophes to ASCII."""
    return F.translate(_col(c), SINGLE_QUOTES + DOUBLE_QUOTES,
                       "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES))


def unescape_html(c) -> Column:
    """Numeric and named character references (those of HTML 4 and ``&apos;``),
    each decoded once.  The text is cut at ``&``: every piece but the first
    starts with a reference or is left as it was."""
    names = {**{n: chr(p) for n, p in name2codepoint.items()}, "apos": "'"}
    book = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])

    def decode(piece: Column) -> Column:
        ref = F.regexp_extract(piece, ENTITY, 1)
        number = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(F.substring(ref, 3, 8), 16, 10)).otherwise(
            F.substring(ref, 2, 8)).try_cast("int")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\uFFFD"))
        found = F.when(F.startswith(ref, F.lit("#")), numeric).otherwise(F.try_element_at(book, ref))
        plain = F.concat(F.lit("&"), piece)
        return F.when(ref == "", plain).otherwise(F.coalesce(F.concat(found, F.substr(piece, F.length(ref) + 2)), plain))

    return F.array_join(F.transform(F.split(_col(c), "&", -1), lambda piece, i: F.when(i == 0, piece).otherwise(decode(piece))), "")


def _decoded(c: Column) -> Column:
    """``decode_mojibake`` of a text without the seam character, which it cannot
    bring in.  ``c`` is named once: steps that name their input several times are
    evaluated as often, and nested levels multiply that."""
    pieces = F.split(F.regexp_replace(c, F.lit(f"({MOJIBAKE_SEQUENCE})"), F.lit(f"{SEAM}$1{SEAM}")), SEAM, -1)
    plain = lambda p: F.decode(F.encode(F.translate(p, CP1252_FROM, CP1252_TO), "ISO-8859-1"), "UTF-8")
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, plain(p)).otherwise(p)), "")


def decode_mojibake(c) -> Column:
    """Every garbled character decoded once: back to its bytes, read as UTF-8.  A
    text that holds the seam character stays as it is."""
    c = _col(c)
    return F.when(F.instr(c, SEAM) > 0, c).otherwise(_decoded(c))


def _decoded_runs(c: Column) -> Column:
    """All levels of ``_decoded`` of a text without the seam character, in the runs
    beyond ASCII alone: garbled characters neither cross nor leave them."""
    def levels(p: Column) -> Column:
        for _ in range(GARBLING_LEVELS):
            p = _decoded(p)
        return p

    pieces = F.split(F.regexp_replace(c, F.lit(BEYOND_ASCII_RUN), F.lit(f"{SEAM}$1{SEAM}")), SEAM, -1)
    return F.array_join(F.transform(pieces, lambda p, i: F.when((i % 2 == 1) & p.rlike(MOJIBAKE_SCAN), levels(p)).otherwise(p)), "")


def _repaired(c: Column) -> Column:
    """C2 of a text without control characters that holds a trigger."""
    rep = F.when(F.instr(c, SEAM) > 0, c).otherwise(_decoded_runs(c))
    literal = (F.instr(c, "<") > 0) | (F.instr(c, "&") == 0)  # decoding brings in no ASCII character
    return _once(F.when(literal, rep).otherwise(unescape_html(rep)),
                 lambda r: F.when(r.rlike(LIGATURE_CLASS), _replace_all(r, LIGATURES)).otherwise(r))


def fix_encoding(c) -> Column:
    """C2 (native): control characters, mojibake (Latin-1 or cp1252, garbled up to
    three times), C1 controls, HTML entities (only when the text has no '<'),
    full-width forms and Latin ligatures; then C1.  One scan finds the texts
    that need any of it."""
    def changed(x: Column) -> Column:
        rep = _once(_re(x, CONTROL_CHARS_PATTERN, ""), lambda y: F.when(y.rlike(REPAIR_SCAN), _repaired(y)).otherwise(y))
        return F.translate(rep, SINGLE_FROM, SINGLE_TO)

    return _once(_col(c), lambda x: F.when(x.rlike(NOT_PLAIN) & x.rlike(REPAIR_OR_MAP), changed(x)).otherwise(x))


def remove_urls(c) -> Column:
    return _re(_col(c), URL_PATTERN)


def remove_mentions(c) -> Column:
    return _re(_col(c), MENTION_PATTERN)


def normalize_hashtags(c) -> Column:
    return _re(_col(c), HASHTAG_PATTERN, "$1")


def remove_emojis(c) -> Column:
    return _re(_re(_col(c), ASTRAL_PATTERN), EMOTICON_PATTERN)


def remove_special_characters(c) -> Column:
    return _re(_col(c), SPECIAL_CLASS)


def normalize_spaces(c) -> Column:
    return F.trim(_re(_col(c), SPACES_PATTERN, " "))


def _cleaned(texts: pa.Array) -> pa.Array:
    from lexis.functions.cleaner import clean  # it takes this module's patterns
    return pa.array([clean("" if t is None else t.decode("utf-8", "replace")) for t in texts.cast(pa.binary()).to_pylist()], pa.string())


_clean_words = F.arrow_udf(_cleaned, T.StringType())
_clean_once = F.arrow_udf(_cleaned, T.StringType()).asNondeterministic()


def clean_text(c, shared: bool = False) -> Column:
    """Null -> ''; C2 -> lower -> C3 -> C4 -> C5 -> C6 -> C7 -> C8 (order matters),
    all in one Arrow UDF: see ``lexis.functions.cleaner``.  A ``shared`` column is
    not merged into the columns made of it, which would clean once for each."""
    return (_clean_once if shared else _clean_words)(_col(c).cast("string"))


def has_mojibake(c) -> Column:
    """True when the text holds a typical mis-decoding marker."""
    return F.coalesce(_col(c).rlike(MOJIBAKE_PATTERN), F.lit(False))


def char_length(c) -> Column:
    """C16 as BIGINT (the width DuckDB's length returns)."""
    return F.char_length(_col(c)).cast("long")


def whitespace_tokens(c) -> Column:
    """Whitespace split with empty pieces dropped (Python ``str.split()``)."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), SPACES_PATTERN), lambda t: t != "")


def token_count(c) -> Column:
    """C17 as BIGINT."""
    return F.size(whitespace_tokens(c)).cast("long")


def alpha_tokens(c) -> Column:
    """``[a-z]+`` runs of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(ALPHA_TOKEN_PATTERN), 0)


def word_tokens(c) -> Column:
    """Vectoriser tokens, two or more word characters, lower-cased.  In an ASCII
    text these are whole runs, which need no look at word boundaries."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.when(F.octet_length(low) == F.char_length(low), F.regexp_extract_all(low, F.lit(ASCII_WORD_TOKEN_PATTERN), 0)).otherwise(
        F.regexp_extract_all(low, F.lit(WORD_TOKEN_PATTERN), 0))


def _grams_of(w: Column, n: int) -> Column:
    """n-grams as the element-wise join of n shifted slices of ``w``: the token
    array is read n + 1 times per row, never once per n-gram."""
    m = F.size(w) - (n - 1)
    zipped = F.arrays_zip(*[F.slice(w, k + 1, F.greatest(m, F.lit(0))).alias(f"t{k}") for k in range(n)])
    grams = F.transform(zipped, lambda x: F.concat_ws(" ", *[x[f"t{k}"] for k in range(n)]))
    return F.when(m > 0, grams).otherwise(F.array().cast("array<string>"))


def ngrams(tokens, lo: int, hi: int) -> Column:
    """All n-grams for n in [lo, hi], words joined by one space, in n then position order.

    Works on any token expression; see ``_grams_of``."""
    w = _col(tokens)
    parts = [w if n == 1 else _grams_of(w, n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)
