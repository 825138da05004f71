"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.llm import language_id, lm, oracles, url_filter
from lexis.llm.decontaminate import contaminated
from lexis.llm.edit_fingerprints import fingerprint_with_next
from lexis.llm.html_text import main_texts
from lexis.llm.mixing import mix_sources
from lexis.llm.near_dup import near_duplicates
from lexis.llm.quality import classify
from lexis.llm.registry import ORACLE, QUERIES, register, table  # noqa: F401
from lexis.llm.substring_dedup import dedup_substrings
from lexis.llm.vp_search import nearest
from lexis.llm.walsh_clusters import cluster
from lexis.llm.whitening import whiten


def held_out(parts: int):
    """True for documents whose crc32 of the doc_id's text is divisible by ``parts``
    (a null doc_id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts == 0


@register("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, threshold and decision for every document."""
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


@register("op2_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url: the longest rule, else the trained model."""
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model, rules).drop("url")


@register("op3_benchmark_decontamination", oracles.DECONTAMINATION)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains to 80 % of
    its 5-word shingles."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney score of every document, trained on nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out(10))
    model = lm.train(docs.filter(~F.col("held_out")))
    return lm.score(docs, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score",
        "perplexity")


@register("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(5))
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), model)


@register("op7_source_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document: weights 3, 1, 2 and 150 % of all words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs, weights=(3, 1, 2), share=1.5, most=2.0).select("doc_id", "size", "source_size", "target", "taken")


@register("op8_minhash_near_dedup", oracles.NEAR_DEDUP)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, similarity
    at least 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@register("op9_substring_dedup", oracles.SUBSTRING_DEDUP)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 35-word windows removed from all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs, window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50 (exact)."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 50 == 0, k=5, factor=1.0)


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 largest whitened components of every vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, components=16, scale=64, offset=1_000_000)


@register("op12_centroid_clustering", oracles.CLUSTERS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cluster(vectors, k=8, rounds=10, scale=1024, seed="3")


@register("op13_document_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text edited by the next one."""
    return fingerprint_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
