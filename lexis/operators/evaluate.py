"""Evaluation aggregates (G1-G10) over a scored frame ``(label, prediction, probability)``.

Counts are one aggregate.  ROC-AUC and the ROC curve are exact: rows are
first grouped by distinct score (a partial aggregate), then negatives below
each score come from ``bucketed_running_sum`` over quantile buckets of the
score — no window over all scores in one task.  AUC = sum over scores of
pos(s) * (neg(<s) + neg(=s)/2) / (P * N), ties counting one half; it is null
when a class is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.operators.rank import bucketed_running_sum, quantile_bucket

ROUND = 4
COUNTS = ("tp", "tn", "fp", "fn")


def _ratio(n, d):
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def confusion(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """G1: tp, tn, fp, fn."""
    y, p = F.col(label), F.col(pred)
    return scored.agg(F.count_if((y == 1) & (p == 1)).cast("long").alias("tp"),
                      F.count_if((y == 0) & (p == 0)).cast("long").alias("tn"),
                      F.count_if((y == 0) & (p == 1)).cast("long").alias("fp"),
                      F.count_if((y == 1) & (p == 0)).cast("long").alias("fn"))


def rates(conf: DataFrame) -> DataFrame:
    """Tpr, fpr, precision, recall, f1 with zero-division -> 0, 4 dp."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return conf.select(
        "tp", "tn", "fp", "fn",
        F.round(rec, ROUND).alias("tpr"), F.round(_ratio(fp, fp + tn), ROUND).alias("fpr"),
        F.round(prec, ROUND).alias("precision"), F.round(rec, ROUND).alias("recall"),
        F.round(_ratio(2 * prec * rec, prec + rec), ROUND).alias("f1"))


def score_counts(scored: DataFrame, label: str, score: str, groups: list[str]) -> DataFrame:
    return scored.groupBy(*groups, score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                              F.count_if(F.col(label) == 0).alias("neg"))


def _with_below(counts: DataFrame, score: str, groups: list[str], n_buckets: int) -> DataFrame:
    b = quantile_bucket(counts, score, "_b", n_buckets)
    return bucketed_running_sum(b, groups, [F.asc(score)], "_b", ["pos", "neg"], inclusive=False,
                                prefix="below_").drop("_b")


def roc_auc(scored: DataFrame, label: str = "label", score: str = "probability",
            groups: list[str] | None = None, n_buckets: int = 1024) -> DataFrame:
    """Exact ROC-AUC (per group when ``groups`` is given)."""
    groups = groups or []
    c = _with_below(score_counts(scored, label, score, groups), score, groups, n_buckets)
    agg = c.groupBy(*groups).agg(F.sum(F.col("pos") * (F.col("below_neg") + 0.5 * F.col("neg"))).alias("_u"),
                                 F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_u") / (F.col("_p") * F.col("_n")))
    return agg.select(*groups, auc.alias("auc"))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "probability",
              n_buckets: int = 1024) -> DataFrame:
    """One point per distinct score (threshold, fpr, tpr) plus the origin
    (null threshold); collinear points are kept."""
    c = _with_below(score_counts(scored, label, score, []), score, [], n_buckets)
    totals = scored.agg(F.count_if(F.col(label) == 1).alias("P"), F.count_if(F.col(label) == 0).alias("N")).first()
    P, N = totals["P"], totals["N"]
    pts = c.select(F.round(F.col(score).cast("double"), 6).alias("threshold"),
                   F.round(_ratio(F.lit(N) - F.col("below_neg"), F.lit(N)), 6).alias("fpr"),
                   F.round(_ratio(F.lit(P) - F.col("below_pos"), F.lit(P)), 6).alias("tpr"))
    origin = scored.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(pts)


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """The 2x2 matrix in long form, absent cells 0."""
    spark: SparkSession = scored.sparkSession
    grid = spark.createDataFrame([(t, p) for t in (0, 1) for p in (0, 1)], "true_label int, pred_label int")
    counts = scored.groupBy(F.col(label).cast("int").alias("true_label"),
                            F.col(pred).cast("int").alias("pred_label")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["true_label", "pred_label"], "left").select(
        "true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def binary_metrics(scored: DataFrame, label: str = "label", pred: str = "prediction",
                   score: str = "probability") -> DataFrame:
    """G1-G4 as one metric row: counts, rates and AUC (4 dp).

    The two single-row results are unioned in long form and pivoted back (an
    aggregate over ten rows) rather than joined."""
    r = rates(confusion(scored, label, pred))
    a = roc_auc(scored, label, score).select(F.round("auc", ROUND).alias("auc"))
    names = r.columns + ["auc"]
    wide = metrics_long(r).unionByName(metrics_long(a)).groupBy().pivot("metric", names).agg(F.first("value"))
    return wide.select(*[F.col(c).cast("long" if c in COUNTS else "double").alias(c) for c in names])


def cv_summary(fold_auc: DataFrame, fold: str = "fold") -> DataFrame:
    """G7/G9: 'Fold i' rows (1-based) then mean and population std, 4 dp."""
    rows = fold_auc.select(F.concat(F.lit("Fold "), (F.col(fold) + 1).cast("string")).alias("name"),
                           F.round("auc", ROUND).alias("value"))
    stats = fold_auc.agg(F.round(F.avg("auc"), ROUND).alias("mean"), F.round(F.stddev_pop("auc"), ROUND).alias("std"))
    return rows.unionByName(stats.select(F.expr("stack(2, 'mean', mean, 'std', std) AS (name, value)")))


def metrics_long(metrics: DataFrame) -> DataFrame:
    """A one-row metric frame as (metric, value) rows."""
    cols = metrics.columns
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return metrics.selectExpr(f"stack({len(cols)}, {stack}) AS (metric, value)")
