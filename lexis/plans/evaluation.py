"""Registered evaluation queries (section G) on a deterministic score.

The score ``least(1, n_tokens / 500)`` of each labelled document (prediction
= score >= 0.5) makes every metric oracle-checkable without a fitted model;
the model-based jobs (``evaluate_job``) use the same operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as tx
from lexis.operators import evaluate as ev
from lexis.operators import split as sp
from lexis.plans import sql as S
from lexis.plans.registry import register
from lexis.plans.splits import _SPLIT, _holdout
from lexis.sources.corpus import labelled

SCORE_TOKENS = 500.0


def score_col(text_col: str = "title_text"):
    return F.least(F.lit(1.0), tx.token_count(text_col) / F.lit(SCORE_TOKENS))


def scored(spark, sf):
    s = labelled(spark, sf).select("text_id", "label", score_col().alias("probability"))
    return s.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


_SCORED = f"""scored AS (SELECT text_id, label, least(1.0, n_tok / {SCORE_TOKENS}) AS probability,
  CAST(least(1.0, n_tok / {SCORE_TOKENS}) >= 0.5 AS INTEGER) AS prediction
  FROM (SELECT text_id, label, {S.token_count('title_text')} AS n_tok FROM labelled))"""
_CONF = """conf AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn FROM scored)"""


def _auc_cte(src: str, name: str, groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups}" if groups else ""
    return f"""{name}_g AS (SELECT {g}probability, count_if(label = 1) AS pos, count_if(label = 0) AS neg
                 FROM {src} GROUP BY {g}probability),
{name}_c AS (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY probability
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below_neg,
                 coalesce(sum(pos) OVER ({part} ORDER BY probability
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below_pos FROM {name}_g),
{name} AS (SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                 THEN sum(pos * (below_neg + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc
           FROM {name}_c {('GROUP BY ' + groups) if groups else ''})"""


def _rates_sql(src: str) -> str:
    return f"""SELECT tp, tn, fp, fn, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 4) AS tpr,
  round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END, 4) AS fpr,
  round(prec, 4) AS precision, round(rec, 4) AS recall,
  round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END, 4) AS f1
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS prec,
                CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS rec FROM {src})"""


@register("confusion", S.with_corpus("SELECT * FROM conf", _SCORED + ",\n" + _CONF))
def confusion(spark, sf):
    """G1: confusion counts."""
    return ev.confusion(scored(spark, sf))


@register("binary_metrics", S.with_corpus(
    "SELECT r.*, round(a.auc, 4) AS auc FROM (" + _rates_sql("conf") + ") r, auc_all a",
    _SCORED + ",\n" + _CONF + ",\n" + _auc_cte("scored", "auc_all")))
def binary_metrics(spark, sf):
    """Counts, tpr, fpr, precision, recall, f1, auc."""
    return ev.binary_metrics(scored(spark, sf))


@register("roc_auc", S.with_corpus("SELECT round(auc, 6) AS auc FROM auc_all",
                                   _SCORED + ",\n" + _auc_cte("scored", "auc_all")))
def roc_auc(spark, sf):
    """Exact AUC with ties counted one half."""
    return ev.roc_auc(scored(spark, sf)).select(F.round("auc", 6).alias("auc"))


@register("roc_curve", S.with_corpus("""
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT round(CAST(probability AS DOUBLE), 6) AS threshold,
  round(CASE WHEN t.n > 0 THEN (t.n - below_neg) / t.n ELSE 0 END, 6) AS fpr,
  round(CASE WHEN t.p > 0 THEN (t.p - below_pos) / t.p ELSE 0 END, 6) AS tpr
FROM auc_all_c, (SELECT count_if(label = 1) AS p, count_if(label = 0) AS n FROM scored) t""",
    _SCORED + ",\n" + _auc_cte("scored", "auc_all")))
def roc_curve(spark, sf):
    """ROC points per distinct score plus the origin."""
    return ev.roc_curve(scored(spark, sf))


@register("confusion_matrix", S.with_corpus("""
SELECT g.t AS true_label, g.p AS pred_label, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(t, p)) g
LEFT JOIN (SELECT label AS t, prediction AS p, count(*) AS n FROM scored GROUP BY 1, 2) c ON g.t = c.t AND g.p = c.p""",
    _SCORED))
def confusion_matrix(spark, sf):
    """2x2 matrix in long form."""
    return ev.confusion_matrix(scored(spark, sf))


_FOLDS = _SPLIT + """,
train AS (SELECT text_id, label FROM holdout WHERE split = 'train'),
folds AS (SELECT t.text_id, t.label, CAST((c.off + row_number() OVER (PARTITION BY t.label
           ORDER BY md5('42:' || CAST(t.text_id AS VARCHAR)), t.text_id) - 1) % 5 AS INTEGER) AS fold
  FROM train t JOIN (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING
       AND 1 PRECEDING), 0) AS off FROM (SELECT label, count(*) AS n FROM train GROUP BY label)) c ON t.label = c.label),
fold_scored AS (SELECT f.fold, s.* FROM folds f JOIN scored s ON f.text_id = s.text_id)"""


def fold_aucs(spark, sf):
    train = _holdout(spark, sf).where("split = 'train'").drop("split")
    folds = sp.stratified_kfold(train, n_splits=5)
    fs = folds.join(scored(spark, sf).drop("label"), "text_id")
    return ev.roc_auc(fs, groups=["fold"])


@register("cv_summary", S.with_corpus("""
SELECT 'Fold ' || CAST(fold + 1 AS VARCHAR) AS name, round(auc, 4) AS value FROM fold_auc
UNION ALL SELECT 'mean', round(avg(auc), 4) FROM fold_auc
UNION ALL SELECT 'std', round(stddev_pop(auc), 4) FROM fold_auc""",
    _SCORED + ",\n" + _FOLDS + ",\n" + _auc_cte("fold_scored", "fold_auc", "fold")))
def cv_summary(spark, sf):
    """AUC of the score on each of the 5 training folds, mean and population std."""
    return ev.cv_summary(fold_aucs(spark, sf))


@register("metrics_row", S.with_corpus("""
SELECT 'cv_auc_mean' AS metric, round(avg(auc), 4) AS value FROM fold_auc
UNION ALL SELECT 'cv_auc_std', round(stddev_pop(auc), 4) FROM fold_auc
UNION ALL SELECT unnest(['tp', 'tn', 'fp', 'fn', 'tpr', 'fpr', 'precision', 'recall', 'f1', 'auc']),
                 unnest([tp, tn, fp, fn, tpr, fpr, precision, recall, f1, auc])
FROM (SELECT r.*, round(a.auc, 4) AS auc FROM (""" + _rates_sql("conf_test") + """) r, auc_test a)""",
    _SCORED + ",\n" + _FOLDS + ",\n" + _auc_cte("fold_scored", "fold_auc", "fold") + """,
test_scored AS (SELECT s.* FROM scored s JOIN holdout h ON s.text_id = h.text_id WHERE h.split = 'test'),
conf_test AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn FROM test_scored),
""" + _auc_cte("test_scored", "auc_test")))
def metrics_row(spark, sf):
    """CV mean/std on the training folds merged with the holdout test metrics, as (metric, value)."""
    fa = fold_aucs(spark, sf)
    cv = fa.agg(F.round(F.avg("auc"), 4).alias("cv_auc_mean"), F.round(F.stddev_pop("auc"), 4).alias("cv_auc_std"))
    test_ids = _holdout(spark, sf).where("split = 'test'").select("text_id")
    test = scored(spark, sf).join(test_ids, "text_id", "left_semi")
    return ev.metrics_long(cv).unionByName(ev.metrics_long(ev.binary_metrics(test)))
