"""Registered source and sink queries (section A).  Each writes Spark-derived
data below the shared folder and reads it back through the library's reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.operators import evaluate as ev
from lexis.operators import jobs
from lexis.operators import models as md
from lexis.operators import split as sp
from lexis.plans import sql as S
from lexis.plans.evaluation import _CONF, _SCORED, _auc_cte, _rates_sql, scored
from lexis.plans.models import CFG, LR_PARAMS, SVM_PARAMS, checked, docs, holdout
from lexis.plans.registry import register
from lexis.plans.search import RESULTS_CTES, TRIALS_CTE, variant_results
from lexis.plans.splits import _SPLIT
from lexis.session import shared_path
from lexis.sources import csv as cs
from lexis.sources import sinks as sk
from lexis.sources import trials as tr
from lexis.sources.corpus import labelled
from lexis.sources.tables import POST_COLUMNS, posts


def _posts_csv(spark, sf, gaps: bool = False) -> str:
    return cs.write_csv(posts(spark, sf, gaps), shared_path(spark, "posts-csv"))


_POSTS_AS_STRINGS = "WITH " + S.posts_cte(gaps=True) + """
SELECT user_id, CAST(text_id AS VARCHAR) AS text_id, title, text, label_raw FROM posts"""


@register("csv_scan", _POSTS_AS_STRINGS)
def csv_scan(spark, sf):
    """A1: posts written as RFC-4180 CSV (multi-line texts) and scanned with a declared schema."""
    return cs.csv_scan(spark, _posts_csv(spark, sf, gaps=True), POST_COLUMNS)


@register("schema_gate", """
SELECT * FROM (VALUES ('exact', true), ('reordered', false), ('missing_column', false), ('extra_column', false),
                      ('mixed_folder', false)) v(check_name, ok)
WHERE (SELECT count(*) FROM documents) > 0""")
def schema_gate(spark, sf):
    """A2: the gate on several written variants of the posts: exact, reordered, a column short, a column more,
    and a folder in which one file's columns are swapped."""
    p = posts(spark, sf, gaps=True)
    turned = p.select(*reversed(POST_COLUMNS))
    variants = {"exact": [p], "reordered": [turned], "missing_column": [p.select(POST_COLUMNS[:-1])],
                "extra_column": [p.withColumn("extra", F.lit("x"))], "mixed_folder": [p, turned]}
    rows = []
    for name, parts in variants.items():
        path = shared_path(spark, f"gate-{name}")
        for part in parts:
            cs.write_csv(part, path, mode="append")
        rows.append((name, cs.schema_validation(spark, path, POST_COLUMNS)))
    return spark.createDataFrame(rows, "check_name string, ok boolean")


@register("ingest", S.with_corpus("""
SELECT user_id, CAST(text_id AS VARCHAR) AS text_id, title, text, label, title_text FROM corpus"""))
def ingest(spark, sf):
    """A3/A4: gate -> CSV load -> fill '' -> title_text -> label 0/1 from the written file."""
    df = cs.ingest(spark, _posts_csv(spark, sf), POST_COLUMNS, ["title", "text"], "label_raw", "yes", "no")
    return df.withColumnRenamed("label_raw", "label").select("user_id", "text_id", "title", "text", "label",
                                                             "title_text")


@register("split_sink", S.with_corpus("SELECT text_id, label, split FROM holdout", _SPLIT))
def split_sink(spark, sf):
    """A5: holdout written partitioned by split and read back."""
    split = sp.stratified_split(labelled(spark, sf).select("text_id", "label"))
    path = sk.write_split(split, shared_path(spark, "split"))
    return sk.read_split(spark, path).select("text_id", "label", "split")


_BLIND_AS_STRINGS = S.with_corpus("""
SELECT CAST(text_id AS VARCHAR) AS text_id, true AS class_ok, true AS range_ok, true AS rule_ok FROM corpus WHERE label IS NULL""")


@register("predict_sink", _BLIND_AS_STRINGS)
def predict_sink(spark, sf):
    """Blind predictions written as CSV with header and read back."""
    all_docs = docs(spark, sf)
    m = md.fit(all_docs.where("label IS NOT NULL"), "logreg", LR_PARAMS, CFG)
    pred = jobs.blind_predictions(m, all_docs.where("label IS NULL"))
    path = sk.write_predictions(pred, shared_path(spark, "predictions"))
    return checked(cs.csv_scan(spark, path, ["text_id", "prediction", "probability"]), dp=4)


@register("metrics_sink", S.with_corpus(
    "SELECT r.*, round(a.auc, 4) AS auc FROM (" + _rates_sql("conf") + ") r, auc_all a",
    _SCORED + ",\n" + _CONF + ",\n" + _auc_cte("scored", "auc_all")))
def metrics_sink(spark, sf):
    """The metric row written as JSON and read back."""
    path = sk.write_metrics(ev.binary_metrics(scored(spark, sf)), shared_path(spark, "metrics"))
    return spark.read.json(path)


@register("model_roundtrip", S.with_corpus("""
SELECT text_id, model, true AS same FROM holdout, (VALUES ('logreg'), ('rff_svc')) v(model) WHERE split = 'test'""", _SPLIT))
def model_roundtrip(spark, sf):
    """Fitted pipelines saved, loaded and re-scored; ``same`` compares the two probabilities."""
    train, test = holdout(spark, sf)
    out = None
    for name, params in (("logreg", LR_PARAMS), ("rff_svc", SVM_PARAMS)):
        m = md.fit(train, name, params, CFG)
        loaded = sk.load_model(sk.save_model(m, shared_path(spark, "model")))
        a = md.predict(m, test, ["text_id"]).withColumnRenamed("probability", "p_fit")
        b = md.predict(loaded, test, ["text_id"]).select("text_id", F.col("probability").alias("p_loaded"))
        rows = a.join(b, "text_id").select("text_id", F.lit(name).alias("model"), (F.col("p_fit") == F.col("p_loaded")).alias("same"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("results_upsert", S.with_corpus("""
SELECT entry, test_auc, cv_auc FROM results WHERE entry <> 'base'
UNION ALL SELECT 'base', cv_auc, test_auc FROM results WHERE entry = 'base'
UNION ALL SELECT 'tokens_optimization', test_auc, cv_auc FROM results WHERE entry = 'base'""", RESULTS_CTES))
def results_upsert(spark, sf):
    """A new run replaces the 'base' entry and adds a model entry; other entries are kept."""
    existing = variant_results(spark, sf)
    base = existing.where("entry = 'base'")
    new = base.select("entry", F.col("cv_auc").alias("test_auc"), F.col("test_auc").alias("cv_auc")).unionByName(
        base.select(F.lit("tokens_optimization").alias("entry"), "test_auc", "cv_auc"))
    return sk.upsert(existing, new, "entry")


@register("trial_log_scan", f"""WITH {TRIALS_CTE}
SELECT study, row_number() OVER (ORDER BY trial_id, study) - 1 AS trial_id, state, value, min_df, max_df,
       CAST(epoch(started + to_seconds(0)) AS BIGINT) AS started_epoch FROM (
  SELECT *, TIMESTAMP '{tr.EPOCH}' + to_seconds(CAST(trial_id AS BIGINT)) AS started FROM trials)""")
def trial_log_scan(spark, sf):
    """A10: trials of several studies written as one journal (create / start / param / finish lines without
    ids of their own) and scanned back; a trial's id is its start line's position."""
    path = tr.write_journal(tr.trial_rows(spark, sf), shared_path(spark, "journal"))
    t = tr.scan_journal(spark, path)
    return t.select("study", "trial_id", "state", "value", F.element_at("params", "min_df").alias("min_df"),
                    F.element_at("params", "max_df").alias("max_df"),
                    F.unix_timestamp("started").alias("started_epoch"))


@register("results_scan", S.with_corpus("SELECT entry, test_auc, cv_auc FROM results", RESULTS_CTES))
def results_scan(spark, sf):
    """Consolidated results written as one keyed JSON object and scanned back to rows."""
    path = tr.write_results(variant_results(spark, sf), shared_path(spark, "results"))
    return tr.scan_results(spark, path).select("entry", "test_auc", "cv_auc")
