"""Corpus profiling (H1-H21): lengths, class balance, duplicates, markers,
token statistics per class and discriminative terms.

Input is an ingested corpus with an id, a text column and an integer label.
All counts are partial (map-side) aggregates, so one huge class, one hot
token or one massively repeated text is pre-combined before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexis.functions import text as tx
from lexis.operators.nulls import is_deleted, is_removed
from lexis.operators.rank import exact_percentiles, top_k_per_group, value_counts
from lexis.session import materialize

DESCRIBE_PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
DESCRIBE_NAMES = ["p01", "p05", "p25", "p50", "p75", "p95", "p99"]


def lengths(df: DataFrame, id_col: str = "text_id", text_col: str = "title_text") -> DataFrame:
    """C16/C17 per document."""
    return df.select(id_col, "label", tx.char_length(text_col).alias("n_chars"),
                     tx.token_count(text_col).alias("n_tokens"))


def null_census(df: DataFrame) -> DataFrame:
    """H1: one row per column: name, Spark type, null count."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', '{t}', `{c}`" for c, t in df.dtypes)
    return counts.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, column_type, n_null)")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """H2: count and share per class (the total is a window over the per-class rows only)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return per.select(label, "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """n_neg, n_pos and scale_pos_weight = n_neg / n_pos."""
    return df.agg(F.count_if(F.col(label) == 0).cast("long").alias("n_neg"),
                  F.count_if(F.col(label) == 1).cast("long").alias("n_pos")).select(
        "n_neg", "n_pos",
        F.round(F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")), 6).alias("scale_pos_weight"))


def length_describe(lens: DataFrame) -> DataFrame:
    """H4/H6: count, mean, sample std, min, percentiles, max for n_chars and n_tokens, 1 dp.

    One pass over the documents writes the counts of the distinct lengths; every
    figure is taken from that table, the percentiles by running counts per bucket
    (``exact_percentiles``), so no task holds all lengths of a measure."""
    measures = ("n_chars", "n_tokens")
    long = lens.select(F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("length"))
                                           for m in measures])).alias("_m")).select("_m.*")
    values = materialize(value_counts(long, ["measure"], "length"), "lengths")
    v, n = F.col("value"), F.col("n")
    base = values.groupBy("measure").agg(F.sum("n").alias("count"), (F.sum(v * n) / F.sum("n")).alias("_mean"),
                                         F.min("value").alias("_min"), F.max("value").alias("_max"))
    spread = values.join(F.broadcast(base), "measure").groupBy("measure").agg(
        F.sqrt(F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))) / F.nullif(F.max("count") - 1, F.lit(0))).alias("_std"))
    every = lens.sparkSession.createDataFrame([(m,) for m in measures], "measure string")
    rows = (every.join(F.broadcast(base), "measure", "left").join(F.broadcast(spread), "measure", "left")
            .join(F.broadcast(exact_percentiles(values, ["measure"], DESCRIBE_PROBS, "_p")), "measure", "left"))
    return rows.select("measure", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                       F.round("_mean", 1).alias("mean"), F.round("_std", 1).alias("std"),
                       F.round(F.col("_min").cast("double"), 1).alias("min"),
                       *[F.round(F.col("_p")[i], 1).alias(c) for i, c in enumerate(DESCRIBE_NAMES)],
                       F.round(F.col("_max").cast("double"), 1).alias("max"))


def length_histogram(lens: DataFrame, col: str = "n_tokens", bins: int = 60) -> DataFrame:
    """H5: equal-width histogram with every bin present; the maximum falls in the last bin."""
    mn, mx = lens.agg(F.min(col), F.max(col)).first()
    spark = lens.sparkSession
    if mn is None:
        return spark.createDataFrame([], "bin long, lo double, hi double, n long")
    width = max(mx - mn, 1)
    b = F.least(F.floor((F.col(col) - F.lit(mn)) * bins / F.lit(width)) + 1, F.lit(bins)).cast("long")
    counts = lens.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(1, bins + 1).withColumnRenamed("id", "bin")
    return (grid.join(counts, "bin", "left").select(
        "bin",
        F.round(F.lit(mn) + (F.col("bin") - 1) * F.lit(mx - mn) / bins, 6).alias("lo"),
        F.round(F.lit(mn) + F.col("bin") * F.lit(mx - mn) / bins, 6).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def length_box_by_class(lens: DataFrame, col: str = "n_tokens", label: str = "label") -> DataFrame:
    """H7: quartiles, 1.5 IQR whiskers (most extreme data inside the fences) and outlier count per class.

    Taken from the written counts of distinct lengths per class (see ``length_describe``)."""
    values = materialize(value_counts(lens, [label], col), "lengths")
    q = exact_percentiles(values, [label], [0.25, 0.5, 0.75], "_q")
    q = q.select(label, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo, hi = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    v = F.col("value")
    return (values.join(F.broadcast(q), label).groupBy(label, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= lo, v)).cast("double").alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).cast("double").alias("whisker_hi"),
        F.sum(F.when((v < lo) | (v > hi), F.col("n")).otherwise(0)).cast("long").alias("n_outliers"))
        .select(label, *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")],
                "n_outliers"))


def short_docs(lens: DataFrame, max_tokens: int = 10, label: str = "label") -> DataFrame:
    """Documents with at most ``max_tokens`` tokens: overall and per class, share of the corpus."""
    flagged = lens.select(label, (F.col("n_tokens") <= max_tokens).alias("_short"))
    per = flagged.groupBy(label).agg(F.count_if("_short").cast("long").alias("n"),
                                     F.count(F.lit(1)).alias("_docs"))
    per = per.select(F.coalesce(F.col(label).cast("string"), F.lit("null")).alias("group"), "n", "_docs")
    rows = per.unionByName(per.agg(F.lit("all").alias("group"), F.sum("n").cast("long").alias("n"),
                                   F.lit(0).cast("long").alias("_docs")))
    total = F.sum("_docs").over(Window.partitionBy())  # window over at most classes + 1 rows
    return rows.select("group", "n", F.round(F.col("n") / total, 6).alias("share"))


def longest_docs(df: DataFrame, lens_k: int = 5, id_col: str = "text_id", text_col: str = "title_text") -> DataFrame:
    """Top documents by token count, with a 200-character preview."""
    return (df.select(id_col, "label", tx.token_count(text_col).alias("n_tokens"),
                      F.concat(F.substring(text_col, 1, 200), F.lit("...")).alias("preview"))
            .orderBy(F.desc("n_tokens"), F.asc(id_col)).limit(lens_k))


def placeholder_census(df: DataFrame, text_col: str = "text", label: str = "label") -> DataFrame:
    """B12/H10: '[removed]' (whole stripped text) and '[deleted]' (contained) counts per class."""
    marked = df.select(label, is_removed(text_col).alias("removed"), is_deleted(text_col).alias("deleted"))
    return (marked.groupBy(label).agg(F.count_if("removed").cast("long").alias("n_removed"),
                                      F.count_if("deleted").cast("long").alias("n_deleted")))


def duplicate_counts(df: DataFrame, id_col: str = "text_id", text_col: str = "title_text") -> DataFrame:
    """Rows beyond the first per id and per exact text (by its 256-bit digest, so no text is shuffled)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
                  .cast("long").alias("dup_by_id"),
                  (F.count(F.lit(1)) - F.count_distinct(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
                  .cast("long").alias("dup_by_text"))


def duplicate_groups(df: DataFrame, id_col: str = "text_id", text_col: str = "title_text") -> DataFrame:
    """Every member of every repeated-text group (``keep=False``).

    Group sizes come from a partial aggregate on a 256-bit digest (a hot text
    collapses map-side); members are found with a left-semi join on the digest,
    whose skewed partitions AQE splits."""
    keyed = df.withColumn("text_key", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    sizes = keyed.groupBy("text_key").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    return keyed.join(sizes, "text_key").select("text_key", id_col, "user_id", "label", "group_size")


def mojibake_rate(df: DataFrame, id_col: str = "text_id", text_col: str = "title_text") -> DataFrame:
    """Flagged count, rate, and the smallest flagged id as the sample."""
    flag = tx.has_mojibake(text_col)
    return df.agg(F.count_if(flag).cast("long").alias("n_mojibake"), F.count(F.lit(1)).alias("n_docs"),
                  F.min(F.when(flag, F.col(id_col))).alias("sample_id")).select(
        "n_mojibake", "n_docs", F.round(F.col("n_mojibake") / F.col("n_docs"), 6).alias("rate"), "sample_id")


def class_token_counts(df: DataFrame, text_col: str = "title_text", label: str = "label") -> DataFrame:
    """Alphabetic-token frequency per class: ``term, freq_pos, freq_neg``.

    One ``groupBy(term)`` with conditional sums (a pivot on the two known
    classes) — partial aggregation pre-combines hot tokens per task."""
    toks = df.select(label, F.explode(tx.alpha_tokens(text_col)).alias("term"))
    return toks.groupBy("term").agg(F.count_if(F.col(label) == 1).cast("long").alias("freq_pos"),
                                    F.count_if(F.col(label) == 0).cast("long").alias("freq_neg"))


def top_tokens_by_class(counts: DataFrame, k: int = 15) -> DataFrame:
    """Top-k tokens per class by frequency (ties by term), salted two-stage top-k."""
    long = (counts.select("term", F.lit(1).alias("label"), F.col("freq_pos").alias("freq"))
            .unionByName(counts.select("term", F.lit(0).alias("label"), F.col("freq_neg").alias("freq")))
            .where("freq > 0"))
    top = top_k_per_group(long, ["label"], [F.desc("freq"), F.asc("term")], k, salt=F.xxhash64("term"))
    return top.select("label", F.col("rank").cast("long").alias("rank"), "term", "freq")


def top_tokens_outer(top: DataFrame) -> DataFrame:
    """Full outer equi-join of the two top lists on term, missing counts 0."""
    pos = top.where("label = 1").select("term", F.col("freq").alias("freq_pos"))
    neg = top.where("label = 0").select("term", F.col("freq").alias("freq_neg"))
    return (pos.join(neg, "term", "full_outer")
            .select("term", F.coalesce("freq_pos", F.lit(0)).cast("long").alias("freq_pos"),
                    F.coalesce("freq_neg", F.lit(0)).cast("long").alias("freq_neg")))


def vocab_union(df: DataFrame, text_col: str = "title_text", label: str = "label") -> DataFrame:
    """Set union of the positive-class and negative-class vocabularies."""
    return df.where(F.col(label).isin(0, 1)).select(F.explode(tx.alpha_tokens(text_col)).alias("term")).distinct()


def discriminative_terms(counts: DataFrame, min_count: int = 30, k: int = 15) -> DataFrame:
    """Laplace ratio (pos+1)/(neg+1), 2 dp, support >= min_count; top-k each side.

    Both top-k lists are ``orderBy(...).limit(k)`` (a bounded
    TakeOrderedAndProject), ties broken by term."""
    disc = (counts.where(F.col("freq_pos") + F.col("freq_neg") >= min_count)
            .withColumn("ratio", F.round((F.col("freq_pos") + 1) / (F.col("freq_neg") + 1), 2)))
    hi = disc.orderBy(F.desc("ratio"), F.asc("term")).limit(k).withColumn("side", F.lit("pos"))
    lo = disc.orderBy(F.asc("ratio"), F.asc("term")).limit(k).withColumn("side", F.lit("neg"))
    return hi.unionByName(lo).select("side", "term", "freq_pos", "freq_neg", "ratio")
