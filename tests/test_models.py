"""Model-layer properties: logistic optimum, score ranges, determinism, persistence."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexis.operators import models as md
from lexis.operators.tfidf import TfidfConfig
from lexis.plans.models import docs
from lexis.sources.corpus import labelled


@pytest.fixture(scope="module")
def train(spark, sf):
    return docs(spark, sf).where("label IS NOT NULL").cache()


def test_logreg_gradient_is_zero_at_optimum(spark, train):
    cfg = TfidfConfig(max_features=500)
    c = 1.0
    m = md.fit(train, "logreg", {"C": c, "max_iter": 500}, cfg)
    feats = np.array([r[0] for r in m.stages[2].transform(m.stages[1].transform(m.stages[0].transform(train)))
                     .select(vector_to_array("features")).collect()])
    y = np.array([r[0] for r in train.select("label").collect()], dtype=float)
    lr = m.stages[-1]
    w, b = lr.coefficients.toArray(), lr.intercept
    p = 1 / (1 + np.exp(-(feats @ w + b)))
    grad_w = w + c * feats.T @ (p - y)           # d/dw of 1/2 |w|^2 + C * sum(logloss)
    assert np.abs(grad_w).max() / max(1.0, c * len(y)) < 1e-4


def test_predictions_are_probabilities_and_deterministic(spark, sf, train):
    m = md.fit(train, "logreg", {"C": 1.0}, TfidfConfig(max_features=500))
    a = md.predict(m, train, ["text_id"]).orderBy("text_id").collect()
    b = md.predict(m, train, ["text_id"]).orderBy("text_id").collect()
    assert a == b and all(0.0 <= r.probability <= 1.0 for r in a)


def test_registry_rejects_unsupported(spark):
    with pytest.raises(ValueError):
        md.build_classifier("gbt", {"reg_alpha": -0.1}, 10, False)
    with pytest.raises(ValueError):
        md.build_classifier("gbt", {"tree_method": "exact"}, 10, False)
    with pytest.raises(ValueError):
        md.build_classifier("svm_magic", {}, 10, False)


def test_empty_vocabulary_raises(spark):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    with pytest.raises(ValueError):
        md.TfidfVectorizer(config=TfidfConfig(min_df=5)).fit(
            md.TermExtractor(inputCol="text", outputCol="terms").transform(df))


def test_model_roundtrip_identical_scores(spark, sf):
    from lexis.plans import io
    rows = io.model_roundtrip(spark, sf).collect()
    assert rows and all(r.same for r in rows)


def test_cross_validation_shape(spark, sf, train):
    from lexis.operators import jobs
    cv = jobs.cross_validate(train, "logreg", {"C": 1.0}, TfidfConfig(max_features=500), n_splits=3).collect()
    assert [r.fold for r in cv] == [0, 1, 2]
    assert all(0.0 <= r.test_auc <= 1.0 and 0.0 <= r.train_auc <= 1.0 for r in cv)


def test_fold_vocabulary_is_the_total_less_the_fold(spark, train):
    from lexis.operators import jobs
    folds = jobs.FoldTerms(train, (1, 2), n_splits=3)
    cfg = TfidfConfig(ngram_range=(1, 2), min_df=2, max_df=0.9, max_features=300)
    for k in range(3):
        refit = md.TfidfVectorizer(config=cfg).fit(folds.terms.where(F.col("fold") != k))
        shared = folds.vectorizer(k, cfg)
        assert refit.stages[0].vocabulary == shared.stages[0].vocabulary
        assert np.allclose(refit.stages[1].getScalingVec().toArray(), shared.stages[1].getScalingVec().toArray())


def test_term_counts_against_brute_force(spark):
    rows = [(["b", "a", "b"], 0), (["a"], 1), ([], 1), (None, 0), (["a", "a", "c"], 1)]
    df = spark.createDataFrame(rows, "terms array<string>, fold int")
    got = {tuple(r) for r in md.term_counts(df, "terms", ("fold",)).collect()}
    assert got == {("a", 0, 1, 1), ("b", 0, 1, 2), ("a", 1, 2, 3), ("c", 1, 1, 1)}


def test_tree_queries_use_the_estimators_defaults():
    from lexis.operators.models import DEFAULT_GBT
    from lexis.plans.models import GBT_PARAMS
    assert all(GBT_PARAMS[k] == DEFAULT_GBT[k] for k in ("n_estimators", "max_depth", "learning_rate"))


def test_cross_fitted_margins_calibrate_better(spark):
    """Few rows in many random features separate the training rows, so their own margins are far too sure."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 40))
    y = (rng.random(900) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    rows = spark.createDataFrame([(Vectors.dense(v), int(t)) for v, t in zip(x, y)], ["rff", "label"])
    rows = rows.withColumn("n", F.monotonically_increasing_id())
    ids = sorted(r.n for r in rows.select("n").collect())
    rows = rows.withColumn("train", F.col("n").isin(ids[:100])).coalesce(1).cache()
    svm = LinearSVC(featuresCol="rff", labelCol="label", regParam=1e-4, rawPredictionCol="svm_raw", maxIter=15)
    train = svm.fit(rows.where("train"))
    error = {}
    for name, inner in (("in sample", None), ("cross-fitted", svm.copy())):
        platt = md.MarginPlatt(svm=inner).fit(train.transform(rows.where("train")))
        held = platt.transform(train.transform(rows.where("NOT train"))).select(vector_to_array("probability")[1].alias("p"), "label").collect()
        p, t = np.array([r.p for r in held]), np.array([r.label for r in held])
        error[name] = np.mean((p - t) ** 2)
    assert error["cross-fitted"] < error["in sample"] - 0.01


def test_calibration_of_a_tiny_class_takes_the_training_margins(spark):
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors
    rows = spark.createDataFrame([(Vectors.dense([float(i)]), int(i == 9)) for i in range(10)], ["rff", "label"]).coalesce(1)
    svm = LinearSVC(featuresCol="rff", labelCol="label", regParam=0.01, rawPredictionCol="svm_raw", maxIter=3)
    scored = svm.fit(rows).transform(rows)
    assert md.MarginPlatt(svm=svm.copy()).out_of_fold(scored) is scored


def test_linear_fits_take_tasks_by_their_entries(spark, monkeypatch):
    """Few entries in many partitions are fitted in few tasks, to the same model."""
    rows = [(i % 2, Vectors.sparse(4, [i % 4, (i + 1 + i % 2) % 4], [1.0, 0.5 + i % 3]) if i % 4 < (i + 1 + i % 2) % 4 else Vectors.sparse(4, [0], [1.0 + i % 5]))
            for i in range(200)]
    df = spark.createDataFrame(rows, ["label", "features"]).repartition(16)
    parts = []
    fit = LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, data: parts.append(data.rdd.getNumPartitions()) or fit(self, data))
    one = md.fit_on_vectors(df, "logreg", {"C": 1.0}).stages[-1]
    monkeypatch.setattr(md, "ENTRIES_PER_PART", 1)
    many = md.fit_on_vectors(df, "logreg", {"C": 1.0}).stages[-1]
    assert parts == [1, 16]
    assert abs(one.coefficients.toArray() - many.coefficients.toArray()).max() < 1e-6
