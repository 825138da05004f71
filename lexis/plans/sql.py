"""DuckDB-dialect SQL for the oracle side of every registered query.

The oracle is an independent statement of each query's meaning in ANSI SQL
(DuckDB), run by the driver on the same Parquet tables.  The helpers here
spell the shared stand-in corpus and the text-cleaning expressions with the
same fixed patterns as ``lexis.functions.text`` (RE2 reads them like Java).
"""

from __future__ import annotations

from lexis.functions import text as tx
from lexis.sources import tables as tb


# The references that occur in the stand-in posts and what they mean; &amp; last
# so that "&amp;lt;" unescapes once, to "&lt;".
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#8217;", "’"), ("&#x2019;", "’"), ("&rsquo;", "’"),
            ("&eacute;", "é"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re(e: str, pattern: str, repl: str = " ") -> str:
    return f"regexp_replace({e}, {lit(pattern)}, {lit(repl)}, 'g')"


def _replace_all(e: str, pairs) -> str:
    for a, b in pairs:
        e = f"replace({e}, {lit(a)}, {lit(b)})"
    return e


def normalize_quotes(e: str) -> str:
    return (f"translate({e}, {lit(tx.SINGLE_QUOTES + tx.DOUBLE_QUOTES)}, "
            f"{lit(chr(39) * len(tx.SINGLE_QUOTES) + chr(34) * len(tx.DOUBLE_QUOTES))})")


def decode_mojibake(e: str) -> str:
    """Code points of each garbled character as hexadecimal bytes, read as UTF-8."""
    marked = f"regexp_replace({e}, {lit(f'({tx.MOJIBAKE_SEQUENCE})')}, {lit(tx.SEAM + chr(92) + '1' + tx.SEAM)}, 'g')"
    codes = f"list_transform(string_split(translate(p, {lit(tx.CP1252_FROM)}, {lit(tx.CP1252_TO)}), ''), lambda ch: printf('%02X', unicode(ch)))"
    return (f"array_to_string(list_transform(string_split({marked}, {lit(tx.SEAM)}), lambda p, i: "
            f"CASE WHEN i % 2 = 0 THEN decode(unhex(array_to_string({codes}, ''))) ELSE p END), '')")


def fix_encoding(e: str) -> str:
    e = _re(e, tx.CONTROL_CHARS_PATTERN, "")
    rep = e
    for _ in range(tx.GARBLING_LEVELS):
        rep = decode_mojibake(rep)
    rep = f"(CASE WHEN instr({rep}, '<') > 0 THEN {rep} ELSE {_replace_all(rep, ENTITIES)} END)"
    rep = _replace_all(rep, tx.LIGATURES)
    e = f"(CASE WHEN regexp_matches({e}, {lit(tx.REPAIR_TRIGGER)}) THEN {rep} ELSE {e} END)"
    return f"translate({e}, {lit(tx.SINGLE_FROM)}, {lit(tx.SINGLE_TO)})"


def remove_urls(e: str) -> str:
    return _re(e, tx.URL_PATTERN)


def remove_mentions(e: str) -> str:
    return _re(e, tx.MENTION_PATTERN)


def normalize_hashtags(e: str) -> str:
    return _re(e, tx.HASHTAG_PATTERN, r"\1")


def remove_emojis(e: str) -> str:
    return _re(_re(e, tx.ASTRAL_PATTERN), tx.EMOTICON_PATTERN)


def remove_special(e: str) -> str:
    return _re(e, tx.SPECIAL_PATTERN)


def normalize_spaces(e: str) -> str:
    return f"trim({_re(e, tx.SPACES_PATTERN, ' ')})"


def clean_text(e: str) -> str:
    e = f"coalesce(CAST({e} AS VARCHAR), '')"
    e = f"lower({fix_encoding(e)})"
    for step in (remove_urls, remove_mentions, normalize_hashtags, remove_emojis, remove_special):
        e = step(e)
    return normalize_spaces(e)


def ws_tokens(e: str) -> str:
    """Whitespace tokens with empty pieces dropped."""
    return f"list_filter(string_split_regex(coalesce({e}, ''), {lit(tx.SPACES_PATTERN)}), lambda t: t <> '')"


def token_count(e: str) -> str:
    return f"CAST(len({ws_tokens(e)}) AS BIGINT)"


def alpha_tokens(e: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), {lit(tx.ALPHA_TOKEN_PATTERN)})"


def word_tokens(e: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), {lit(tx.WORD_TOKEN_PATTERN)})"


def posts_cte(gaps: bool = False) -> str:
    removed = f"""WHEN d.doc_id % {tb.TEXT_MOD} = {tb.REMOVED_RESIDUE} THEN '[removed]'
         WHEN d.doc_id % {tb.TEXT_MOD} = {tb.NULL_TEXT_RESIDUE} THEN NULL""" if gaps else ""
    dirt = "[" + ", ".join(lit(s) for s in tb.DIRT) + "]"
    return f"""posts AS (
  SELECT d.source AS user_id, d.doc_id AS text_id,
    CASE WHEN d.doc_id % {tb.TITLE_MOD} = {tb.NULL_TITLE_RESIDUE} THEN NULL ELSE d.lang END AS title,
    CASE WHEN false THEN NULL {removed}
         ELSE d.text || ({dirt})[d.doc_id % {len(tb.DIRT)} + 1] END AS text,
    CASE l.quality WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS label_raw
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def corpus_cte(gaps: bool = False) -> str:
    return posts_cte(gaps) + """,
corpus AS (
  SELECT user_id, text_id, coalesce(title, '') AS title, coalesce(text, '') AS text,
    CASE coalesce(label_raw, '') WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS label,
    coalesce(title, '') || ' ' || coalesce(text, '') AS title_text
  FROM posts),
labelled AS (SELECT * FROM corpus WHERE label IS NOT NULL)"""


def with_corpus(body: str, extra_ctes: str = "", gaps: bool = False) -> str:
    ctes = corpus_cte(gaps) + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
