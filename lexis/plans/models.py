"""Registered model queries (section F).

A fitted model's scores cannot be recomputed in SQL, so the queries return what
can: every expected row, whether its class and probability are valid and agree,
identities of the metrics, and bounds that a fitted model meets and a guess does
not: a training AUC of 0.8, a test AUC above one half, and a test log loss below
that of the training part's class shares, which SQL computes too."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lexis.operators import evaluate as ev
from lexis.operators import jobs
from lexis.operators import models as md
from lexis.operators import split as sp
from lexis.operators.tfidf import TfidfConfig
from lexis.plans import sql as S
from lexis.plans.registry import register
from lexis.plans.splits import _SPLIT
from lexis.session import materialize
from lexis.sources.corpus import corpus

CFG = TfidfConfig()                                            # default vectorizer block
LR_PARAMS = {"C": 1.110118}                                    # tuned logistic block
SVM_PARAMS = {"C": 1.100814, "gamma": 0.385474, "n_components": 256, "calibration_folds": 2}
GBT_PARAMS = {k: md.DEFAULT_GBT[k] for k in ("n_estimators", "max_depth", "learning_rate", "random_state")}


def docs(spark, sf):
    return corpus(spark, sf).select("text_id", "label", F.col("title_text").alias("text"))


def holdout(spark, sf):
    labelled = docs(spark, sf).where("label IS NOT NULL")
    s = sp.stratified_split(labelled)
    return s.where("split = 'train'").drop("split"), s.where("split = 'test'").drop("split")


def _scale_pos_weight(train) -> float:
    r = train.agg(F.count_if(F.col("label") == 0).alias("n"), F.count_if(F.col("label") == 1).alias("p")).first()
    return r["n"] / r["p"] if r["p"] else 1.0


def checked(scored, rule=None, dp: int | None = None):
    """Rows with flags: class in {0, 1}; probability in [0, 1] (of ``dp`` places if
    given); class as the rule (by default probability above one half) says."""
    p = F.col("probability").cast("double")
    valid = (p >= 0) & (p <= 1)
    if dp is not None:
        valid = valid & (F.round(p, dp) == p)
    rule = (p > 0.5) if rule is None else rule
    keep = [c for c in ("text_id", "label") if c in scored.columns]
    edge = F.abs(p - 0.5) < 10.0 ** -(dp or 12)  # rounding may move a score onto the border
    return scored.select(*keep, F.col("prediction").cast("int").isin(0, 1).alias("class_ok"), valid.alias("range_ok"),
                         (edge | ((F.col("prediction").cast("int") == 1) == rule)).alias("rule_ok"))


def bounded(scored, m, train, test, log_loss: bool = True):
    """Adds the bounds of the module's docstring to checked test rows."""
    parts = train.select("text_id", "label", "text", F.lit("train").alias("split")).unionByName(
        test.select("text_id", "label", "text", F.lit("test").alias("split")))
    rows = materialize(md.predict(m, parts, ["label", "split"]), "bounds")
    auc = {r["split"]: r["auc"] for r in ev.roc_auc(rows, groups=["split"]).collect()}
    p = F.least(F.greatest(F.when(F.col("label") == 1, F.col("probability")).otherwise(1 - F.col("probability")), F.lit(1e-12)), F.lit(1.0))
    in_test, share = F.col("split") == "test", F.lit(train.agg(F.avg("label")).first()[0])
    prior, loss = rows.agg(F.avg(F.when(in_test, -F.log(F.when(F.col("label") == 1, share).otherwise(1 - share)))),
                           F.avg(F.when(in_test, -F.log(p)))).first()
    out = scored.withColumns({"train_auc_ok": F.lit(auc["train"] >= 0.8), "test_auc_ok": F.lit(auc["test"] > 0.5),
                              "prior_log_loss": F.lit(round(prior, 6))})
    return out.withColumn("log_loss_ok", F.lit(loss < prior)) if log_loss else out


_BOUNDS = """, prior AS (SELECT round(avg(-ln(CASE WHEN h.label = 1 THEN t.p ELSE 1 - t.p END)), 6) AS prior_log_loss
  FROM holdout h, (SELECT avg(label) AS p FROM holdout WHERE split = 'train') t WHERE h.split = 'test')"""


def _test_rows(more: str = "", log_loss: bool = True) -> str:
    loss = ", true AS log_loss_ok" if log_loss else ""
    return S.with_corpus(f"""
SELECT text_id, label, true AS class_ok, true AS range_ok, true AS rule_ok, true AS train_auc_ok, true AS test_auc_ok,
  prior_log_loss{loss}{more} FROM holdout, prior WHERE split = 'test'""", _SPLIT + _BOUNDS)


_BLIND_ROWS = S.with_corpus("""
SELECT text_id, true AS class_ok, true AS range_ok, true AS rule_ok FROM corpus WHERE label IS NULL""")


@register("fit_logreg", _test_rows(", true AS stationary"))
def fit_logreg(spark, sf):
    """L2 logistic regression (C = 1.110118) on the training part; checked and bounded test predictions.
    ``stationary``: at the optimum the mean probability of the training rows is their mean label (within
    0.02 after 100 iterations; a test checks the whole gradient at convergence)."""
    train, test = holdout(spark, sf)
    m = md.fit(train, "logreg", LR_PARAMS, CFG)
    gap = md.predict(m, train, ["label"]).agg(F.abs(F.avg("probability") - F.avg("label"))).first()[0]
    scored = checked(md.predict(m, test, ["text_id", "label"])).withColumn("stationary", F.lit(gap < 0.02))
    return bounded(scored, m, train, test)


@register("fit_gbt", _test_rows())
def fit_gbt(spark, sf):
    """500 boosted trees with class weight n_neg/n_pos; checked and bounded test predictions."""
    train, test = holdout(spark, sf)
    m = md.fit(train, "gbt", {**GBT_PARAMS, "scale_pos_weight": _scale_pos_weight(train)}, CFG)
    return bounded(checked(md.predict(m, test, ["text_id", "label"])), m, train, test)


@register("fit_gbt_early_stop", S.with_corpus("""
SELECT text_id, label, true AS class_ok, true AS range_ok, true AS rule_ok, true AS test_auc_ok, true AS val_auc_ok, true AS trees_ok
FROM holdout WHERE split = 'test'""", _SPLIT))
def fit_gbt_early_stop(spark, sf):
    """boosted trees that stop growing by the AUC of the inner 10 % validation part (patience 3); checked
    test predictions.  ``trees_ok``: the trees up to the best are kept and none was grown beyond it by more
    than the patience; ``val_auc_ok``: the kept model reaches the reported validation AUC."""
    train, test = holdout(spark, sf)
    inner = materialize(sp.inner_validation(train), "inner")
    fit_part, val = inner.where("NOT is_validation"), inner.where("is_validation")
    m, n_trees, best = md.gbt_early_stopping(fit_part, val, GBT_PARAMS, CFG, rounds=3)
    trees = m.stages[-1]
    scored = materialize(md.predict(m, val.select("text_id", "label", "text", F.lit("val").alias("part")).unionByName(
        test.select("text_id", "label", "text", F.lit("test").alias("part"))), ["text_id", "label", "part"]), "stopped")
    auc = {r["part"]: r["auc"] for r in ev.roc_auc(scored, groups=["part"]).collect()}
    grown_ok = trees.getNumTrees == n_trees and trees.grown <= min(n_trees + 3, GBT_PARAMS["n_estimators"])
    return checked(scored.where("part = 'test'").drop("part")).withColumns({
        "test_auc_ok": F.lit(auc["test"] > 0.5), "val_auc_ok": F.lit(abs(auc["val"] - best) < 1e-9), "trees_ok": F.lit(grown_ok)})


@register("fit_rff_svm", _test_rows(log_loss=False))
def fit_rff_svm(spark, sf):
    """RBF-SVM approximation (random Fourier features + linear SVM + cross-fitted Platt); the class is the margin's sign."""
    train, test = holdout(spark, sf)
    m = md.fit(train, "rff_svc", SVM_PARAMS, CFG)
    out = m.transform(test).withColumn("probability", vector_to_array("probability")[1])
    return bounded(checked(out, rule=vector_to_array("svm_raw")[1] > 0), m, train, test, log_loss=False)


@register("pipeline_fit_score", _test_rows())
def pipeline_fit_score(spark, sf):
    """Stemming + sublinear 1-2 gram tf-idf + logistic, one pipeline; checked and bounded test scores."""
    train, test = holdout(spark, sf)
    cfg = TfidfConfig(ngram_range=(1, 2), min_df=2, max_df=0.95, sublinear_tf=True, max_features=5000)
    m = md.fit(train, "logreg", LR_PARAMS, cfg, variant="stemming")
    return bounded(checked(md.predict(m, test, ["text_id", "label"])), m, train, test)


@register("predict_blind", _BLIND_ROWS)
def predict_blind(spark, sf):
    """fit on every labelled document, score the unlabelled ones (4 dp)."""
    all_docs = docs(spark, sf)
    m = md.fit(all_docs.where("label IS NOT NULL"), "logreg", LR_PARAMS, CFG)
    return checked(jobs.blind_predictions(m, all_docs.where("label IS NULL")), dp=4)


@register("cv_auc", "SELECT CAST(range AS INTEGER) AS fold, true AS train_auc_ok, true AS test_auc_ok FROM range(0, 5)")
def cv_auc(spark, sf):
    """5-fold CV of the logistic pipeline on the training part: every fold has a train and a test AUC."""
    train, _ = holdout(spark, sf)
    cv = jobs.cross_validate(train, "logreg", LR_PARAMS, CFG)
    return cv.select("fold", *[F.col(c).between(0, 1).alias(f"{c}_ok") for c in ("train_auc", "test_auc")])


_METRIC_NAMES = ["tp", "tn", "fp", "fn", "tpr", "fpr", "precision", "recall", "f1", "auc"]


def _named(names) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', true)" for n in names) + ") v(metric, ok)"


@register("train_job", _named(["cv_auc_mean", "cv_auc_std", *[f"cv_auc_fold_{k}" for k in range(5)], *_METRIC_NAMES]))
def train_job(spark, sf):
    """holdout + CV + final fit; every merged metric row is there and in its range."""
    labelled = docs(spark, sf).where("label IS NOT NULL")
    _, reports = jobs.train_job(labelled, "logreg", LR_PARAMS, CFG)
    counts = F.col("metric").isin("tp", "tn", "fp", "fn")
    return reports["metrics"].select("metric", F.when(counts, F.col("value") >= 0).otherwise(F.col("value").between(0, 1)).alias("ok"))


@register("evaluate_job", S.with_corpus("""
SELECT 'positives' AS item, CAST(count_if(label = 1) AS DOUBLE) AS value FROM holdout WHERE split = 'test'
UNION ALL SELECT 'negatives', CAST(count_if(label = 0) AS DOUBLE) FROM holdout WHERE split = 'test'
UNION ALL SELECT 'matrix_total', CAST(count(*) AS DOUBLE) FROM holdout WHERE split = 'test'
UNION ALL SELECT 'scored', CAST(count(*) AS DOUBLE) FROM holdout WHERE split = 'test'
UNION ALL SELECT 'roc_end_tpr', 1.0
UNION ALL SELECT 'roc_end_fpr', 1.0
UNION ALL SELECT 'auc_in_range', 1.0""", _SPLIT))
def evaluate_job(spark, sf):
    """Fitted pipeline scored once on the test part; identities of its metric row, ROC curve and matrix."""
    train, test = holdout(spark, sf)
    r = jobs.evaluate_model(md.fit(train, "logreg", LR_PARAMS, CFG), test)

    def item(df, name, value):
        return df.agg(F.lit(name).alias("item"), value.cast("double").alias("value"))

    m = r["metrics"]
    parts = [item(m, "positives", F.max(F.col("tp") + F.col("fn"))), item(m, "negatives", F.max(F.col("tn") + F.col("fp"))),
             item(r["confusion"], "matrix_total", F.sum("n")), item(r["scored"], "scored", F.count("*")),
             item(r["roc"], "roc_end_tpr", F.max("tpr")), item(r["roc"], "roc_end_fpr", F.max("fpr")),
             item(m, "auc_in_range", F.max(F.col("auc").between(0, 1).cast("int")))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("predict_stream", _BLIND_ROWS)
def predict_stream(spark, sf):
    """F9 as Structured Streaming: unlabelled documents land as Parquet files and are
    scored by the fitted pipeline in micro-batches (availableNow), then read back."""
    from lexis.session import shared_path
    from lexis.streaming.scoring import read_scores, score_stream
    all_docs = docs(spark, sf)
    m = md.fit(all_docs.where("label IS NOT NULL"), "logreg", LR_PARAMS, CFG)
    unlabelled = all_docs.where("label IS NULL").select("text_id", "text")
    inbox = shared_path(spark, "inbox")
    unlabelled.write.mode("overwrite").parquet(inbox)
    out, ckpt = shared_path(spark, "scored"), shared_path(spark, "scored-ckpt")
    score_stream(spark, m, inbox, unlabelled.schema, out, ckpt)
    return checked(read_scores(spark, out), dp=4)
