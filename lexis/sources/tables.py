"""Access to the driver's Parquet tables and the stand-in post corpus.

The reference ingests CSV files of posts ``user_id, text_id, title, text,
label``.  ``posts`` builds rows of that schema from ``documents LEFT JOIN
labels``; it only shapes input and does none of the library's work.  Because
the generated prose has no URLs, emoji, quote marks, mojibake, placeholders or
nulls, a fixed suffix from ``DIRT`` is appended by ``doc_id`` residue and a few
titles are null, so the cleaning steps have something to act on.  Every text
stays whole; only ``gaps=True``, for the null and placeholder queries, replaces
some texts by ``[removed]`` or null.  The oracle SQL builds the identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

POST_COLUMNS = ["user_id", "text_id", "title", "text", "label_raw"]

# Fixed stand-in suffixes, chosen by doc_id % their number.
DIRT = (
    " see https://example.com/a?b=1 and www.example.org/page ",
    " “Quoted” it’s ‘fine’ «ok» don´t ",
    " 🔥 wow :) =o ;-P 😂 ",
    " @some_user and u/other_name #Hash_Tag # spaced ",
    " canâ€™t stop Ã©tÃ© &amp; co ",
    " [deleted] ",
    "",
    " at https://x.com\u00a0hello\u00a0\u2003world don&#8217;t can&rsquo;t won&#x2019;t caf&eacute; a&nbsp;b &unknown; ",
    " isnÃ¢â‚¬â„¢t itâ€™s Ã¢â‚¬Å“soÃ¢â‚¬\u009d ",
)
REMOVED_RESIDUE, NULL_TEXT_RESIDUE, TEXT_MOD = 5, 9, 11
NULL_TITLE_RESIDUE, TITLE_MOD = 6, 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Text cleaning is CPU-heavy per row: when a scan yields fewer splits than
    the cluster has cores (a small file with one row group), hash-partition the
    rows by ``key`` so every core works.  A large input already has many splits
    and passes through unchanged."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:
        return df
    return df.repartition(2 * par, key)


def posts(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Stand-in post rows ``user_id, text_id, title, text, label_raw``."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    suffix = F.element_at(F.array(*[F.lit(s) for s in DIRT]), (F.col("doc_id") % len(DIRT) + 1).cast("int"))
    text = F.concat(F.col("text"), suffix)
    if gaps:
        text = (F.when(F.col("doc_id") % TEXT_MOD == REMOVED_RESIDUE, F.lit("[removed]"))
                 .when(F.col("doc_id") % TEXT_MOD == NULL_TEXT_RESIDUE, F.lit(None).cast("string"))
                 .otherwise(text))
    title = F.when(F.col("doc_id") % TITLE_MOD == NULL_TITLE_RESIDUE, F.lit(None).cast("string")).otherwise(F.col("lang"))
    label_raw = F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no")
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("source").alias("user_id"), F.col("doc_id").alias("text_id"),
                    title.alias("title"), text.alias("text"), label_raw.alias("label_raw")))
