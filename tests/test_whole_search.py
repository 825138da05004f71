"""The registered whole searches ask for every variant, trial and fold; the Fourier features of a batch."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from lexis.operators import models as md
from lexis.operators import search as se
from lexis.operators import search_jobs as sj
from lexis.plans import search as ps
from lexis.plans.registry import ORACLE, QUERIES, load_all

load_all()


class Asked(Exception):
    pass


def test_search_svm_plans_thirty_trials_of_five_folds(spark, sf, monkeypatch):
    seen = {}

    def folds(train, ngram_range, variant, n_splits, *rest):
        seen["folds"] = n_splits

    def run(spark, plan, objective, path, run_id, n_trials, timeout):
        seen["trials"], seen["plan"] = n_trials, sorted((r["study"], r["trial_id"]) for r in plan.collect())
        raise Asked

    monkeypatch.setattr(sj.jobs, "FoldTerms", folds)
    monkeypatch.setattr(sj.jobs, "fold_vectors", lambda *a: [])
    monkeypatch.setattr(sj.se, "run_search", run)
    with pytest.raises(Asked):
        QUERIES["search_svm"](spark, sf)
    want = [("rff_svc_base", i) for i in range(se.DEFAULT_TRIALS)]
    assert seen == {"folds": sj.FOLDS, "trials": 30, "plan": want} and sj.FOLDS == 5
    assert sorted(r[:2] for r in duckdb.sql(ORACLE["search_svm"]).fetchall()) == want


def test_stage2_job_asks_for_every_variant_trial_and_fold(spark, sf, monkeypatch):
    seen = []

    def vectorizers(train, variants, model, params, path, run_id, n_trials, n_splits):
        seen.append((variants, n_trials, n_splits))
        raise Asked

    monkeypatch.setattr(sj, "search_vectorizers", vectorizers)
    with pytest.raises(Asked):
        QUERIES["stage2_job"](spark, sf)
    assert seen == [(ps.VARIANT_ORDER, 30, 5)] and len(ps.VARIANT_ORDER) == 4

    def stage2(lab, model, results, trials, fixed, path, run_id="stage2", n_trials=se.DEFAULT_TRIALS, n_splits=sj.FOLDS, **kw):
        seen.append((n_trials, n_splits))
        raise Asked

    monkeypatch.setattr(sj, "stage1", lambda *a, **kw: (None, None))
    monkeypatch.setattr(sj, "stage2", stage2)
    with pytest.raises(Asked):
        QUERIES["stage2_job"](spark, sf)
    assert seen[-1] == (30, 5)


def test_fourier_features_of_a_batch_equal_the_formula_row_by_row(spark, monkeypatch):
    monkeypatch.setattr(md, "RFF_CELLS", 20)
    monkeypatch.setattr(md, "RFF_BLOCK", 9)
    rng, dim, gamma, calls = np.random.default_rng(3), 16, 0.4, []
    rows = [{int(i): float(rng.normal()) for i in rng.choice(40, n, replace=False)} for n in (5, 0, 7, 1, 12)]
    gauss = md._gauss
    monkeypatch.setattr(md, "_gauss", lambda seed, r, *rest: calls.append(len(r)) or gauss(seed, r, *rest))
    index = np.array([i for r in rows for i in sorted(r)], np.int32)
    value = np.array([r[i] for r in rows for i in sorted(r)])
    got = md.rff_rows(np.append(0, np.cumsum([len(r) for r in rows])), index, value, gamma, dim, 42)
    assert sum(calls) == len(set(index)) * dim  # a row of the matrix is made once for a column block, not for each row that needs it
    w = gauss(42, np.arange(40), dim) * math.sqrt(2 * gamma)
    b = 2 * np.pi * md._uniform(np.arange(dim, dtype=np.uint64) + np.uint64((42 + 7919) * int(md._GOLDEN) % (1 << 64)))
    dense = np.array([[r.get(i, 0.0) for i in range(40)] for r in rows])
    want = math.sqrt(2 / dim) * np.cos(dense @ w + b)
    assert np.allclose(got, want, atol=1e-12)
    df = spark.createDataFrame([(k, Vectors.sparse(40, r)) for k, r in enumerate(rows)] + [(5, Vectors.dense(dense[0]))], ["k", "features"])
    out = md.RandomFourierFeatures(inputCol="features", outputCol="rff", gamma=gamma, dim=dim).transform(df).orderBy("k").collect()
    assert np.allclose([r["rff"].toArray() for r in out], np.vstack([want, want[:1]]), atol=1e-12)
