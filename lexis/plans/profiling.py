"""Registered corpus-profiling queries (section H of the inventory)."""

from __future__ import annotations

from lexis.operators import profile as pr
from lexis.plans import sql as S
from lexis.plans.registry import register
from lexis.sources.corpus import corpus, labelled
from lexis.sources.tables import posts

_TOKS = f"""toks AS (SELECT label, unnest({S.alpha_tokens('title_text')}) AS term FROM labelled),
counts AS (SELECT term, CAST(count_if(label = 1) AS BIGINT) AS freq_pos,
                  CAST(count_if(label = 0) AS BIGINT) AS freq_neg FROM toks GROUP BY term)"""
_LENS_ALL = f"""lens_all AS (SELECT text_id, label, CAST(length(title_text) AS BIGINT) AS n_chars,
                      {S.token_count('title_text')} AS n_tokens FROM corpus),
lens AS (SELECT * FROM lens_all),
lens_labelled AS (SELECT * FROM lens_all WHERE label IS NOT NULL)"""
_TOP = """long AS (SELECT term, 1 AS label, freq_pos AS freq FROM counts
              UNION ALL SELECT term, 0 AS label, freq_neg AS freq FROM counts),
top AS (SELECT label, rank, term, freq FROM (
          SELECT label, term, freq, row_number() OVER (PARTITION BY label ORDER BY freq DESC, term) AS rank
          FROM long WHERE freq > 0) WHERE rank <= 15)"""


def _counts(spark, sf):
    return pr.class_token_counts(labelled(spark, sf))


@register("discriminative_terms", S.with_corpus("""
SELECT * FROM (SELECT 'pos' AS side, term, freq_pos, freq_neg, ratio FROM disc ORDER BY ratio DESC, term LIMIT 15)
UNION ALL
SELECT * FROM (SELECT 'neg' AS side, term, freq_pos, freq_neg, ratio FROM disc ORDER BY ratio ASC, term LIMIT 15)""",
    _TOKS + """,
disc AS (SELECT term, freq_pos, freq_neg, round((freq_pos + 1) / (freq_neg + 1), 2) AS ratio
         FROM counts WHERE freq_pos + freq_neg >= 30)"""))
def discriminative_terms(spark, sf):
    """Flagship: tokens per class -> Laplace ratio -> top/bottom 15 terms."""
    return pr.discriminative_terms(_counts(spark, sf))


@register("token_counts", S.with_corpus("SELECT term, freq_pos, freq_neg FROM counts", _TOKS))
def token_counts(spark, sf):
    return _counts(spark, sf)


@register("top_tokens_by_class", S.with_corpus("SELECT label, rank, term, freq FROM top", _TOKS + "," + _TOP))
def top_tokens_by_class(spark, sf):
    return pr.top_tokens_by_class(_counts(spark, sf))


@register("top_tokens_outer", S.with_corpus("""
SELECT coalesce(p.term, n.term) AS term, CAST(coalesce(p.freq, 0) AS BIGINT) AS freq_pos,
       CAST(coalesce(n.freq, 0) AS BIGINT) AS freq_neg
FROM (SELECT * FROM top WHERE label = 1) p FULL OUTER JOIN (SELECT * FROM top WHERE label = 0) n ON p.term = n.term""",
    _TOKS + "," + _TOP))
def top_tokens_outer(spark, sf):
    return pr.top_tokens_outer(pr.top_tokens_by_class(_counts(spark, sf)))


@register("vocab_union", S.with_corpus("SELECT DISTINCT term FROM toks WHERE label IN (0, 1)", _TOKS))
def vocab_union(spark, sf):
    return pr.vocab_union(labelled(spark, sf))


@register("null_census", "WITH " + S.posts_cte(gaps=True) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM posts"
    for c, t in [("user_id", "string"), ("text_id", "bigint"), ("title", "string"), ("text", "string"),
                 ("label_raw", "string")]))
def null_census(spark, sf):
    return pr.null_census(posts(spark, sf, gaps=True))


@register("class_balance", S.with_corpus("""
SELECT label, n, round(n / sum(n) OVER (), 6) AS share
FROM (SELECT label, count(*) AS n FROM labelled GROUP BY label)"""))
def class_balance(spark, sf):
    return pr.class_balance(labelled(spark, sf))


@register("class_weight", S.with_corpus("""
SELECT n_neg, n_pos, round(CASE WHEN n_pos > 0 THEN n_neg / n_pos END, 6) AS scale_pos_weight
FROM (SELECT CAST(count_if(label = 0) AS BIGINT) AS n_neg, CAST(count_if(label = 1) AS BIGINT) AS n_pos FROM labelled)"""))
def class_weight(spark, sf):
    return pr.class_weight(labelled(spark, sf))


@register("doc_lengths", S.with_corpus("SELECT text_id, label, n_chars, n_tokens FROM lens_all", _LENS_ALL))
def doc_lengths(spark, sf):
    return pr.lengths(corpus(spark, sf))


def _describe_sql(m: str) -> str:
    ps = ", ".join(f"round(quantile_cont({m}, {p}), 1) AS {n}" for p, n in zip(pr.DESCRIBE_PROBS, pr.DESCRIBE_NAMES))
    return (f"SELECT '{m}' AS measure, count({m}) AS count, round(avg({m}), 1) AS mean, "
            f"round(stddev_samp({m}), 1) AS std, round(CAST(min({m}) AS DOUBLE), 1) AS min, {ps}, "
            f"round(CAST(max({m}) AS DOUBLE), 1) AS max FROM lens")


@register("length_describe", S.with_corpus(_describe_sql("n_chars") + "\nUNION ALL\n" + _describe_sql("n_tokens"),
                                           _LENS_ALL))
def length_describe(spark, sf):
    return pr.length_describe(pr.lengths(corpus(spark, sf)))


@register("length_histogram", S.with_corpus("""
SELECT g.bin, round(mn + (g.bin - 1) * (mx - mn) / 60, 6) AS lo, round(mn + g.bin * (mx - mn) / 60, 6) AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT range AS bin FROM range(1, 61)) g CROSS JOIN mm
LEFT JOIN (SELECT CAST(least(floor((n_tokens - mn) * 60 / greatest(mx - mn, 1)) + 1, 60) AS BIGINT) AS bin,
                  count(*) AS n FROM lens, mm GROUP BY 1) c ON c.bin = g.bin""",
    _LENS_ALL + ",\nmm AS (SELECT min(n_tokens) AS mn, max(n_tokens) AS mx FROM lens)"))
def length_histogram(spark, sf):
    return pr.length_histogram(pr.lengths(corpus(spark, sf)))


@register("length_box_by_class", S.with_corpus("""
SELECT l.label, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
  round(CAST(min(CASE WHEN n_tokens >= q1 - 1.5 * (q3 - q1) THEN n_tokens END) AS DOUBLE), 4) AS whisker_lo,
  round(CAST(max(CASE WHEN n_tokens <= q3 + 1.5 * (q3 - q1) THEN n_tokens END) AS DOUBLE), 4) AS whisker_hi,
  CAST(count_if(n_tokens < q1 - 1.5 * (q3 - q1) OR n_tokens > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM lens_labelled l JOIN (SELECT label, quantile_cont(n_tokens, 0.25) AS q1, quantile_cont(n_tokens, 0.5) AS median,
                         quantile_cont(n_tokens, 0.75) AS q3 FROM lens_labelled GROUP BY label) q ON l.label = q.label
GROUP BY l.label, q1, median, q3""", _LENS_ALL))
def length_box_by_class(spark, sf):
    return pr.length_box_by_class(pr.lengths(labelled(spark, sf)))


@register("short_docs", S.with_corpus("""
SELECT grp AS "group", n, round(n / (SELECT count(*) FROM lens), 6) AS share FROM (
  SELECT coalesce(CAST(label AS VARCHAR), 'null') AS grp, CAST(count_if(n_tokens <= 10) AS BIGINT) AS n FROM lens GROUP BY label
  UNION ALL SELECT 'all', CAST(count_if(n_tokens <= 10) AS BIGINT) FROM lens)""", _LENS_ALL))
def short_docs(spark, sf):
    return pr.short_docs(pr.lengths(corpus(spark, sf)))


@register("longest_docs", S.with_corpus(f"""
SELECT text_id, label, {S.token_count('title_text')} AS n_tokens, substr(title_text, 1, 200) || '...' AS preview
FROM corpus ORDER BY n_tokens DESC, text_id LIMIT 5"""))
def longest_docs(spark, sf):
    return pr.longest_docs(corpus(spark, sf))


@register("placeholder_census", S.with_corpus("""
SELECT label,
  CAST(count_if(trim(regexp_replace(text, '^[\\t\\n\\x0B\\f\\r ]+|[\\t\\n\\x0B\\f\\r ]+$', '', 'g')) = '[removed]') AS BIGINT)
    AS n_removed,
  CAST(count_if(instr(text, '[deleted]') > 0) AS BIGINT) AS n_deleted
FROM corpus GROUP BY label""", gaps=True))
def placeholder_census(spark, sf):
    return pr.placeholder_census(corpus(spark, sf, gaps=True))


@register("duplicate_counts", S.with_corpus("""
SELECT CAST(count(*) - count(DISTINCT CAST(text_id AS VARCHAR)) AS BIGINT) AS dup_by_id,
       CAST(count(*) - count(DISTINCT title_text) AS BIGINT) AS dup_by_text FROM corpus"""))
def duplicate_counts(spark, sf):
    return pr.duplicate_counts(corpus(spark, sf))


@register("duplicate_groups", S.with_corpus("""
SELECT c.text_key, c.text_id, c.user_id, c.label, g.group_size
FROM (SELECT *, sha256(title_text) AS text_key FROM corpus) c
JOIN (SELECT sha256(title_text) AS text_key, count(*) AS group_size FROM corpus GROUP BY 1 HAVING count(*) > 1) g
  ON c.text_key = g.text_key"""))
def duplicate_groups(spark, sf):
    return pr.duplicate_groups(corpus(spark, sf))


@register("mojibake_rate", S.with_corpus(f"""
SELECT n_mojibake, n_docs, round(n_mojibake / n_docs, 6) AS rate, sample_id FROM (
  SELECT CAST(count_if(regexp_matches(title_text, {S.lit(pr.tx.MOJIBAKE_PATTERN)})) AS BIGINT) AS n_mojibake,
         count(*) AS n_docs,
         min(CASE WHEN regexp_matches(title_text, {S.lit(pr.tx.MOJIBAKE_PATTERN)}) THEN text_id END) AS sample_id
  FROM corpus)"""))
def mojibake_rate(spark, sf):
    return pr.mojibake_rate(corpus(spark, sf))
