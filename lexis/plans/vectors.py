"""Registered TF-IDF queries (section D of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as tx
from lexis.operators import tfidf as tf
from lexis.operators.tfidf import TfidfConfig
from lexis.plans import sql as S
from lexis.plans.registry import register
from lexis.sources.corpus import corpus

DEFAULT = TfidfConfig()                      # the reference's default vectorizer block
PRUNE = TfidfConfig(min_df=2, max_df=0.9, max_features=None)
TOPK = TfidfConfig(max_features=2000)
SUBLINEAR = TfidfConfig(ngram_range=(1, 2), min_df=2, max_df=0.95, sublinear_tf=True, max_features=5000)


def clean_docs(spark, sf, where: str = "true"):
    df = corpus(spark, sf).where(where)
    return df.select("text_id", "label", tx.clean_text("title_text").alias("clean"))


def _grams_sql(lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        parts.append("w" if n == 1 else
                     f"list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))")
    return parts[0] if len(parts) == 1 else "list_concat(" + ", ".join(parts) + ")"


def _thr(v) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)" if isinstance(v, int) else f"CAST({float(v)!r} AS DOUBLE) * n"


def tfidf_ctes(cfg: TfidfConfig, fit: str = "corpus", apply: str | None = None) -> str:
    """CTEs ``fit_tf, n, vocab, w`` for a config; ``apply`` names the corpus CTE to weight."""
    lo, hi = cfg.ngram_range
    limit = f"ORDER BY ttf DESC, term LIMIT {cfg.max_features}" if cfg.max_features else ""
    tfw = "(ln(tf) + 1)" if cfg.sublinear_tf else "CAST(tf AS DOUBLE)"

    def tf_of(src: str, name: str) -> str:
        return f"""{name}_docs AS (SELECT text_id, {S.clean_text('title_text')} AS clean FROM {src}),
{name}_tf AS (SELECT text_id, term, count(*) AS tf FROM (
  SELECT text_id, unnest({_grams_sql(lo, hi)}) AS term FROM (
    SELECT text_id, {S.word_tokens('clean')} AS w FROM {name}_docs)) GROUP BY text_id, term)"""

    ctes = tf_of(fit, "fit") + f""",
n AS (SELECT count(*) AS n FROM fit_docs),
dfreq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM fit_tf GROUP BY term),
kept AS (SELECT term, df, ttf FROM dfreq, n WHERE df >= {_thr(cfg.min_df)} AND df <= {_thr(cfg.max_df)} {limit}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS index, df, ttf,
                 ln(CAST(1 + n AS DOUBLE) / (1 + df)) + 1 AS idf FROM kept, n)"""
    src = "fit_tf"
    if apply:
        ctes += ",\n" + tf_of(apply, "app")
        src = "app_tf"
    ctes += f""",
w AS (SELECT t.text_id, t.term, v.index, {tfw} * v.idf AS w FROM {src} t JOIN vocab v ON t.term = v.term),
weights AS (SELECT text_id, term, index, w / sqrt(sum(w * w) OVER (PARTITION BY text_id)) AS tfidf FROM w)"""
    return ctes


def _fit(spark, sf, cfg, where: str = "true"):
    return tf.fit_transform(clean_docs(spark, sf, where), "text_id", "clean", cfg)


@register("ngrams", S.with_corpus(f"""
SELECT text_id, CAST(len(g) AS BIGINT) AS n_grams, md5(array_to_string(g, '|')) AS gram_digest FROM (
  SELECT text_id, {_grams_sql(1, 3)} AS g FROM (
    SELECT text_id, {S.word_tokens(S.clean_text('title_text'))} AS w FROM corpus))"""))
def ngrams(spark, sf):
    """1- to 3-grams per document (count and an md5 digest of the ordered sequence)."""
    toks = clean_docs(spark, sf).select("text_id", tx.word_tokens(F.col("clean")).alias("w"))
    grams = toks.select("text_id", tx.ngrams(F.col("w"), 1, 3).alias("g"))  # made once a row, read twice
    return grams.select("text_id", F.size("g").cast("long").alias("n_grams"), F.md5(F.array_join("g", "|")).alias("gram_digest"))


@register("term_freq", S.with_corpus("SELECT text_id, term, tf FROM fit_tf", tfidf_ctes(DEFAULT)))
def term_freq(spark, sf):
    """Term counts per document."""
    return tf.term_freq(clean_docs(spark, sf), "text_id", "clean", DEFAULT)


@register("doc_freq_prune", S.with_corpus("SELECT term, df, ttf FROM kept", tfidf_ctes(PRUNE)))
def doc_freq_prune(spark, sf):
    """D3: document frequency with min_df=2 (absolute) and max_df=0.9 (proportion)."""
    docs = clean_docs(spark, sf)
    tfr = tf.term_freq(docs, "text_id", "clean", PRUNE)
    return tf.prune(tf.doc_freq(tfr), docs.count(), PRUNE).select("term", "df", "ttf")


@register("vocab_topk", S.with_corpus("SELECT term, index, ttf FROM vocab", tfidf_ctes(TOPK)))
def vocab_topk(spark, sf):
    """D4 + D9 index: the 2000 most frequent surviving terms, indexed alphabetically."""
    docs = clean_docs(spark, sf)
    return tf.fit_vocabulary(tf.term_freq(docs, "text_id", "clean", TOPK), docs.count(), TOPK) \
        .select("term", "index", "ttf")


@register("idf", S.with_corpus("SELECT term, df, round(idf, 6) AS idf FROM vocab", tfidf_ctes(DEFAULT)))
def idf(spark, sf):
    """Smoothed idf of the fitted vocabulary."""
    vocab, _ = _fit(spark, sf, DEFAULT)
    return vocab.select("term", "df", F.round("idf", 6).alias("idf"))


@register("tfidf", S.with_corpus("SELECT text_id, term, index, round(tfidf, 6) AS tfidf FROM weights",
                                 tfidf_ctes(DEFAULT)))
def tfidf(spark, sf):
    """L2-normalised tf-idf, default vectorizer config, long form."""
    _, w = _fit(spark, sf, DEFAULT)
    return w.select("text_id", "term", "index", F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_sublinear", S.with_corpus("SELECT text_id, term, index, round(tfidf, 6) AS tfidf FROM weights",
                                           tfidf_ctes(SUBLINEAR)))
def tfidf_sublinear(spark, sf):
    """Sublinear tf, 1-2 grams, min_df 2, max_df .95, 5000 features."""
    _, w = _fit(spark, sf, SUBLINEAR)
    return w.select("text_id", "term", "index", F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_transform", S.with_corpus(
    "SELECT text_id, term, index, round(tfidf, 6) AS tfidf FROM weights",
    "unlabelled AS (SELECT * FROM corpus WHERE label IS NULL),\n" + tfidf_ctes(DEFAULT, fit="labelled", apply="unlabelled")))
def tfidf_transform(spark, sf):
    """Vocabulary fitted on labelled documents applied to the unlabelled ones."""
    vocab, _ = _fit(spark, sf, DEFAULT, "label IS NOT NULL")
    w = tf.transform(clean_docs(spark, sf, "label IS NULL"), vocab, "text_id", "clean", DEFAULT)
    return w.select("text_id", "term", "index", F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_vectors", S.with_corpus("""
SELECT c.text_id, c.label, CAST((SELECT count(*) FROM vocab) AS BIGINT) AS size, w.index, round(w.tfidf, 6) AS value
FROM corpus c LEFT JOIN weights w ON c.text_id = w.text_id""", tfidf_ctes(DEFAULT)))
def tfidf_vectors(spark, sf):
    """Sparse vectors (alphabetical index) of every document, one row per entry
    (a zero vector is one row without entry)."""
    vocab, words = tf.fit(clean_docs(spark, sf), "text_id", "clean", DEFAULT)
    v = tf.vectors(words, vocab, DEFAULT)
    return v.select("text_id", "label", F.unwrap_udt("features")["size"].cast("long").alias("size"),
                    F.explode_outer(tf.entries()).alias("_e")).select(
        "text_id", "label", "size", "_e.index", F.round("_e.value", 6).alias("value"))
