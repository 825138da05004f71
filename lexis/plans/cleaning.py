"""Registered text-cleaning queries (sections B and C of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import stopwords as sw
from lexis.functions import text as tx
from lexis.operators import clean as cl
from lexis.operators.nulls import concat_columns, handle_missing, map_label
from lexis.plans import sql as S
from lexis.plans.registry import register
from lexis.plans.stem_sql import stem_ctes
from lexis.sources.corpus import corpus
from lexis.sources.tables import posts


def _step(key: str, col_fn, sql_fn):
    @register(key, S.with_corpus(f"SELECT text_id, {sql_fn('title_text')} AS cleaned FROM corpus"))
    def run(spark, sf):
        return corpus(spark, sf).select("text_id", col_fn(F.col("title_text")).alias("cleaned"))
    run.__doc__ = f"{key} applied to every document's title_text."
    return run


_step("normalize_quotes", tx.normalize_quotes, S.normalize_quotes)
_step("remove_urls", tx.remove_urls, S.remove_urls)
_step("remove_mentions", tx.remove_mentions, S.remove_mentions)
_step("normalize_hashtags", tx.normalize_hashtags, S.normalize_hashtags)
_step("remove_emojis", tx.remove_emojis, S.remove_emojis)
_step("remove_special", tx.remove_special_characters, S.remove_special)
_step("normalize_spaces", tx.normalize_spaces, S.normalize_spaces)
_step("clean_text", tx.clean_text, S.clean_text)


def _drop_words_sql(e: str, words: list[str]) -> str:
    arr = "[" + ", ".join(S.lit(w) for w in words) + "]"
    return (f"array_to_string(list_filter(string_split({e}, ' '), "
            f"lambda t: t <> '' AND NOT list_contains({arr}, t)), ' ')")


_GENERAL_SQL = _drop_words_sql(S.clean_text("title_text"), sw.general_without_negations())
_CURATED_SQL = _drop_words_sql(S.clean_text("title_text"), sw.curated())


@register("clean_stop_general", S.with_corpus(f"SELECT text_id, {_GENERAL_SQL} AS cleaned FROM corpus"))
def clean_stop_general(spark, sf):
    return corpus(spark, sf).select("text_id", cl.clean_general("title_text").alias("cleaned"))


@register("clean_stop_curated", S.with_corpus(f"SELECT text_id, {_CURATED_SQL} AS cleaned FROM corpus"))
def clean_stop_curated(spark, sf):
    return corpus(spark, sf).select("text_id", cl.clean_curated("title_text").alias("cleaned"))


@register("clean_stem", S.with_corpus("""
SELECT t.text_id, string_agg(s.stem, ' ' ORDER BY t.pos) AS cleaned
FROM (SELECT text_id, unnest(string_split(cleaned, ' ')) AS tok, generate_subscripts(string_split(cleaned, ' '), 1) AS pos FROM base) t
JOIN stems s ON s.tok = t.tok GROUP BY t.text_id""",
    f"base AS (SELECT text_id, {S.clean_text('title_text')} AS cleaned FROM corpus),\n" + stem_ctes("base")))
def clean_stem(spark, sf):
    """Base clean, then the Porter stem of every token."""
    return cl.clean_frame(corpus(spark, sf).select("text_id", "title_text"), "title_text", "stemming") \
        .select("text_id", F.col("title_text").alias("cleaned"))


@register("fix_encoding", S.with_corpus(f"SELECT text_id, {S.fix_encoding('title_text')} AS cleaned FROM corpus"))
def fix_encoding(spark, sf):
    """Encoding repair of every document."""
    return corpus(spark, sf).select("text_id", tx.fix_encoding("title_text").alias("cleaned"))


def _variant_stats_sql(name: str, expr: str) -> str:
    return f"""SELECT '{name}' AS variant, CAST(sum(len(toks)) AS BIGINT) AS n_tokens,
  CAST(count_if(len(toks) = 0) AS BIGINT) AS n_empty FROM (
  SELECT list_filter(string_split({expr}, ' '), lambda t: t <> '') AS toks FROM corpus)"""


@register("variant_compare", S.with_corpus("\nUNION ALL\n".join([
    _variant_stats_sql("base", S.clean_text("title_text")),
    _variant_stats_sql("stopwords_general", _GENERAL_SQL),
    _variant_stats_sql("stopwords_curated", _CURATED_SQL),
    _variant_stats_sql("stemming", S.clean_text("title_text"))])))  # stemming keeps the number of tokens
def variant_compare(spark, sf):
    """C14: all variants through the registry, token totals and empty outputs per variant."""
    names = list(cl.VARIANTS)
    cleaned = cl.with_variants(corpus(spark, sf).select("title_text"), "title_text", names)
    sizes = cleaned.select(*[tx.token_count(f"clean_{v}").alias(v) for v in names])  # one pass over the texts
    totals = sizes.agg(*[x for v in names for x in (F.sum(v).alias(f"{v}_tokens"), F.count_if(F.col(v) == 0).cast("long").alias(f"{v}_empty"))])
    stack = ", ".join(f"'{v}', {v}_tokens, {v}_empty" for v in names)
    return totals.selectExpr(f"stack({len(names)}, {stack}) AS (variant, n_tokens, n_empty)")


@register("tokenize_words", S.with_corpus(f"""
SELECT text_id, CAST(generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos, unnest(toks) AS token
FROM (SELECT text_id, {S.word_tokens(S.clean_text('title_text'))} AS toks FROM corpus)"""))
def tokenize_words(spark, sf):
    """Vectoriser tokens of the cleaned text, one row per (document, position)."""
    return corpus(spark, sf).select("text_id", F.posexplode(tx.word_tokens(tx.clean_text("title_text")))
                                    .alias("pos", "token")).withColumn("pos", F.col("pos").cast("long"))


@register("preprocess_frame", S.with_corpus(
    f"SELECT user_id, text_id, title, text, label, {S.clean_text('title_text')} AS title_text FROM corpus"))
def preprocess_frame(spark, sf):
    """title_text replaced by its cleaned form, every other column kept."""
    return cl.clean_frame(corpus(spark, sf), "title_text", "base")


_POST_COLS = "user_id, text_id, title, text, label_raw"


@register("null_fill_empty", "WITH " + S.posts_cte(gaps=True) + """
SELECT coalesce(user_id, '') AS user_id, text_id, coalesce(title, '') AS title, coalesce(text, '') AS text,
       coalesce(label_raw, '') AS label_raw FROM posts""")
def null_fill_empty(spark, sf):
    """B1: every string column filled with ''."""
    return handle_missing(posts(spark, sf, gaps=True), None, "empty_string")


@register("null_drop", "WITH " + S.posts_cte(gaps=True) + f"\nSELECT {_POST_COLS} FROM posts WHERE title IS NOT NULL AND text IS NOT NULL")
def null_drop(spark, sf):
    """B2: rows with a null title or text dropped."""
    return handle_missing(posts(spark, sf, gaps=True), ["title", "text"], "drop")


@register("null_placeholder", "WITH " + S.posts_cte(gaps=True) + """
SELECT user_id, text_id, coalesce(title, 'missing_data') AS title, coalesce(text, 'missing_data') AS text,
       label_raw FROM posts""")
def null_placeholder(spark, sf):
    """Nulls in title and text replaced by 'missing_data'."""
    return handle_missing(posts(spark, sf, gaps=True), ["title", "text"], "placeholder")


@register("concat_text", "WITH " + S.posts_cte(gaps=True) + """
SELECT text_id, coalesce(title, '') || ' ' || coalesce(text, '') AS title_text FROM posts""")
def concat_text(spark, sf):
    """Title and text joined by one space, nulls as ''."""
    return concat_columns(posts(spark, sf, gaps=True), ["title", "text"]).select("text_id", "title_text")


@register("label_map", "WITH " + S.posts_cte(gaps=True) + """
SELECT text_id, CASE label_raw WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS label FROM posts""")
def label_map(spark, sf):
    """B5: 'yes' -> 1, 'no' -> 0, anything else null."""
    return map_label(posts(spark, sf, gaps=True), "label_raw", "yes", "no").select("text_id", F.col("label_raw").alias("label"))
