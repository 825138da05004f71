"""Training-corpus pipeline: five stages, each one operator of ``lexis.llm``.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows its
predecessor kept; all but the last return the columns of ``documents``.  ``run``
writes each stage's result as Parquet in the shared folder and reads it again,
so a lost executor never costs more than the running stage.

Defined cases: rows with a null doc_id pass the near-duplicate and the
decontamination stage (they cannot be named as copies or as contaminated); of
rows that repeat a doc_id the near-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexis.llm.decontaminate import clean
from lexis.llm.mixing import mix_sources
from lexis.llm.near_dup import near_duplicates
from lexis.llm.quality import classify
from lexis.llm.registry import table
from lexis.llm.substring_dedup import dedup_substrings
from lexis.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier keeps."""
    judged = classify(docs, table(spark, sf_dir, "labels"), with_text=True)
    return judged.filter("kept").select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    kept = near_duplicates(docs, shingle=5, percent=80).filter("kept").select("doc_id").distinct()
    rows = docs.filter("doc_id is not null").join(kept, "doc_id")
    first = W.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    rows = rows.withColumn("__nth", F.row_number().over(first)).filter("__nth = 1").select(*docs.columns)
    return rows.union(docs.filter("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that occur more than once."""
    cut = dedup_substrings(docs, window=50)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes of each (a
    multiple of ``size``: repeats count)."""
    return mix_sources(docs, weights=(3, 1, 2), share=1.5, most=2.0).filter("taken > 0")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# Perplexities, signatures and hash sketches are not SQL: the stages are tested
# against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the cleaned documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
