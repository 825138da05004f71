"""Search contracts: resume, failures, fresh starts, plans, and the trial log's own ids."""

import json

import pytest
from pyspark.sql import functions as F

from lexis.operators import evaluate as ev
from lexis.operators import models as md
from lexis.operators import search as se
from lexis.session import shared_path
from lexis.sources import csv as cs
from lexis.sources import trials as tr


def plan(spark, n):
    return se.trial_plan(spark.createDataFrame([("a",), ("b",)], "study string"), n, {"x": ("float", 0.0, 1.0)})


def test_resume_runs_only_what_is_missing(spark):
    path, seen = shared_path(spark, "trials"), []

    def objective(study, p):
        seen.append((study, p["x"]))
        if p["x"] > 0.5:
            raise ValueError("bad parameters")
        return p["x"]

    first = se.run_search(spark, plan(spark, 2), objective, path, "run", n_trials=2)
    assert first.count() == 4 and len(seen) == 4
    again = se.run_search(spark, plan(spark, 3), objective, path, "run", n_trials=3)
    assert again.count() == 6 and len(seen) == 6  # failed trials count as complete with 0.0 and do not run again
    rows = again.collect()
    assert all(r.state == "complete" and r.value == (r.params["x"] if r.params["x"] <= 0.5 else 0.0) for r in rows)
    assert se.run_search(spark, plan(spark, 1), objective, path, "fresh", n_trials=1).count() == 2 and len(seen) == 8
    assert se.run_search(spark, plan(spark, 9), objective, path, "late", n_trials=9, timeout_sec=0.0).count() == 0


def test_lost_infrastructure_ends_the_search(spark):
    def objective(study, p):
        raise OSError("executor lost")

    with pytest.raises(OSError):
        se.run_search(spark, plan(spark, 1), objective, shared_path(spark, "trials"), "run", n_trials=1)


def test_plan_in_chunks_equals_one_sequence(spark, monkeypatch):
    monkeypatch.setattr(se, "PLAN_CHUNK", 4)
    rows = sorted((r.study, r.trial_id) for r in plan(spark, 11).collect())
    assert rows == [(s, i) for s in "ab" for i in range(11)]


def test_journal_ids_are_line_positions(spark, tmp_path):
    names = ["tfidf_stopwords_nltk", "tfidf_stopwords_domain", "tfidf_stemming"]
    lines = [{"op_code": 0, "worker_id": "w", "study_name": n, "directions": [2]} for n in names]
    for i in range(6):
        lines.append({"op_code": 4, "worker_id": "w", "study_id": i % 3, "datetime_start": "2024-01-01T00:00:0%d" % i})
        lines.append({"op_code": 5, "worker_id": "w", "trial_id": i, "param_name": "C", "param_value_internal": float(i),
                      "distribution": "{}"})
        lines.append({"op_code": 6, "worker_id": "w", "trial_id": i, "state": 1 + i % 2, "values": [i / 10], "datetime_complete": None})
    log = tmp_path / "study.journal"
    log.write_text("".join(json.dumps(x) + "\n" for x in lines))
    rows = {r.trial_id: r for r in tr.scan_journal(spark, str(log)).collect()}
    assert len(rows) == 6
    assert all(rows[i].study == names[i % 3] and rows[i].params == {"C": float(i)} and rows[i].value == i / 10 for i in range(6))


def test_results_document_over_many_lines(spark, tmp_path):
    doc = {"base": {"best_params": {"min_df": 4}, "optuna": {"best_cv_auc": 0.75, "n_trials": 3}, "test": {"AUC": 0.7, "TP": 9, "F1": 0.6}},
           "lr_optimization": {"best_params": {"C": 1.5}, "best_cv_auc": 0.77, "test": {"AUC": 0.72, "TP": 8}}}
    path = tmp_path / "results.json"
    path.write_text(json.dumps(doc, indent=2))
    rows = {r.entry: r for r in tr.scan_results(spark, str(path)).collect()}
    assert (rows["base"].test_auc, rows["base"].cv_auc, rows["base"].TP, rows["base"].F1) == (0.7, 0.75, 9.0, 0.6)
    assert (rows["lr_optimization"].cv_auc, rows["lr_optimization"].best_params) == (0.77, {"C": "1.5"})


def test_csv_gate_reads_every_file_and_null_spellings(spark):
    path = shared_path(spark, "csv")
    cs.write_csv(spark.createDataFrame([("u1", "t1"), ("NA", "null")], "user_id string, text_id string"), path)
    assert cs.schema_validation(spark, path, ["user_id", "text_id"])
    rows = sorted(map(tuple, cs.csv_scan(spark, path, ["user_id", "text_id"]).collect()), key=str)
    assert rows == sorted([("u1", "t1"), (None, None)], key=str)
    cs.write_csv(spark.createDataFrame([("t2", "u2")], "text_id string, user_id string"), path, mode="append")
    assert not cs.schema_validation(spark, path, ["user_id", "text_id"])
    with pytest.raises(Exception):
        cs.csv_scan(spark, path, ["user_id", "text_id"]).collect()


def test_auc_needs_raw_scores(spark):
    rows = [(1, 0.00013), (0, 0.00012), (1, 0.00011), (0, 0.00009)]
    df = spark.createDataFrame(rows, "label int, probability double").withColumn("prediction", F.lit(0))
    raw, cut = (ev.roc_auc(x).first()["auc"] for x in (df, md.rounded(df)))
    assert raw == 0.75 and cut != raw


def test_missing_label_and_reserved_parameters(spark):
    from lexis.operators import jobs
    with pytest.raises(ValueError, match="target column"):
        jobs.require_label(spark.createDataFrame([("x",)], "text string"))
    with pytest.raises(ValueError, match="early_stopping_rounds"):
        md.build_classifier("gbt", {"early_stopping_rounds": 5}, 1.0, False)
    with pytest.raises(ValueError, match="max_depth"):
        md.build_classifier("gbt", {"max_depth": 31}, 1.0, False)
