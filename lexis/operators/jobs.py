"""Training, cross-validation and scoring jobs (F9-F12) composed from the
split, pipeline and evaluation operators.  Every step is a Spark job; fold
fits are submitted from driver threads so Spark runs them concurrently."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators import evaluate as ev
from lexis.operators import models as md
from lexis.operators import split as sp
from lexis.operators.tfidf import TfidfConfig
from lexis.session import materialize


class FoldTerms:
    """Cleaned terms of a training part with their folds, and the frequencies of
    every (term, fold), each written once: all trials with the same variant and
    n-gram range share them.  A fold's vocabulary is the total less its own rows,
    so no vocabulary or idf leaks from a held-out fold and nothing is counted twice."""

    def __init__(self, train: DataFrame, ngram_range: tuple[int, int], variant: str = "base", n_splits: int = 5, seed: int = 42,
                 text_col: str = "text"):
        folds = sp.stratified_kfold(train, n_splits=n_splits, seed=seed)
        cfg = TfidfConfig(ngram_range=ngram_range)
        self.n_splits = n_splits
        self.terms = materialize(md.prepare_terms(folds.select("text_id", "label", "fold", text_col), cfg, variant, text_col)
                                 .drop(text_col), "cv-terms")
        self.counts = materialize(md.term_counts(self.terms, "terms", ("fold",)), "cv-counts")
        self.sizes = {r["fold"]: r["count"] for r in self.terms.groupBy("fold").count().collect()}  # a row per fold

    def vectorizer(self, k: int, cfg: TfidfConfig) -> PipelineModel:
        """The vectoriser fitted on all folds but ``k``."""
        rest = self.counts.where(F.col("fold") != k).groupBy("term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))
        fitted = md.TfidfVectorizer(inputCol="terms", outputCol="features", config=cfg)
        return fitted.from_counts(rest, sum(n for f, n in self.sizes.items() if f != k))

    def vectors(self, k: int, cfg: TfidfConfig) -> DataFrame:
        """Features of all rows under fold ``k``'s vectoriser, written once."""
        return materialize(self.vectorizer(k, cfg).transform(self.terms).select("label", "fold", "features"), "cv-vectors")


def fold_scores(vectors: DataFrame, k: int, model: str, params: dict | None) -> DataFrame:
    """``(label, probability, k, held)`` of all rows under the classifier fitted on all folds but ``k``."""
    if model == "rff_svc":  # an AUC follows the order of the margins: their calibration is left out
        params = {**(params or {}), "calibration_folds": 1}
    fitted = md.fit_on_vectors(vectors.where(F.col("fold") != k), model, params)
    return md.predict(fitted, vectors, ["label", "fold"]).select("label", "probability", F.lit(k).alias("k"), (F.col("fold") == k).alias("held"))


def cross_validate_vectors(vectors: list[DataFrame], model: str, params: dict | None, parallelism: int = 5) -> DataFrame:
    """F10 on the folds' vectors: ``(fold, train_auc, test_auc)``."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(vectors)))) as pool:
        scored = list(pool.map(lambda k: fold_scores(vectors[k], k, model, params), range(len(vectors))))
    # written and ranked once for all folds: their AUCs are groups of one set of jobs
    auc = {(r["k"], r["held"]): r["auc"] for r in
           ev.roc_auc(materialize(reduce(DataFrame.unionByName, scored), "cv-scored"), groups=["k", "held"]).collect()}
    return vectors[0].sparkSession.createDataFrame([(k, auc.get((k, False)), auc.get((k, True))) for k in range(len(vectors))],
                                                   "fold int, train_auc double, test_auc double")


def fold_vectors(folds: FoldTerms, cfg: TfidfConfig, parallelism: int = 5) -> list[DataFrame]:
    """Every fold's vectors."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, folds.n_splits))) as pool:
        return list(pool.map(lambda k: folds.vectors(k, cfg), range(folds.n_splits)))


def cross_validate(train: DataFrame, model: str, params: dict | None, cfg: TfidfConfig, variant: str = "base",
                   n_splits: int = 5, seed: int = 42, text_col: str = "text", parallelism: int = 5) -> DataFrame:
    """per fold, the vectoriser and the classifier are refitted on the other
    folds; cleaning, terms and frequencies are computed once (``FoldTerms``).
    Returns (fold, train_auc, test_auc)."""
    folds = FoldTerms(train, cfg.ngram_range, variant, n_splits, seed, text_col)
    return cross_validate_vectors(fold_vectors(folds, cfg, parallelism), model, params, parallelism)


def evaluate_model(m: PipelineModel, labelled: DataFrame, id_col: str = "text_id") -> dict[str, DataFrame]:
    """Metric row, ROC curve and confusion matrix of one scoring pass."""
    scored = materialize(md.predict(m, require_label(labelled), [id_col, "label"]), "scored")  # read by three reports
    return {"metrics": ev.binary_metrics(scored), "roc": ev.roc_curve(scored),
            "confusion": ev.confusion_matrix(scored), "scored": scored}


def require_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Training and evaluation need the target column."""
    if label not in df.columns:
        raise ValueError(f"target column {label!r} is missing; found {df.columns}")
    return df


def train_job(labelled: DataFrame, model: str, params: dict | None, cfg: TfidfConfig, variant: str = "base",
              test_size: float = 0.2, n_splits: int = 5, seed: int = 42, text_col: str = "text",
              save_to: str | None = None) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """holdout -> CV on the training part -> final fit -> evaluation.

    ``early_stopping_rounds`` of a boosted model takes an inner validation part of
    the training rows.  Returns the model and its reports: ``folds`` (per fold),
    ``metrics`` (CV mean, deviation, fold scores and holdout metrics as rows),
    ``roc``, ``confusion`` and ``scored``; ``save_to`` persists the model."""
    require_label(labelled)
    split = materialize(sp.stratified_split(labelled, test_size=test_size, seed=seed), "holdout")
    train, test = split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")
    params = dict(params or {})
    rounds = params.pop("early_stopping_rounds", None)
    cv = cross_validate(train, model, params, cfg, variant, n_splits, seed, text_col)
    if model == "gbt" and rounds is not None:
        inner = sp.inner_validation(train, seed=f"{seed}:val")
        final, _, _ = md.gbt_early_stopping(inner.where("NOT is_validation"), inner.where("is_validation"), params, cfg,
                                            int(rounds), variant, text_col)
    else:
        final = md.fit(train, model, params, cfg, variant, text_col)
    if save_to:
        final.write().overwrite().save(save_to)
    cv_row = cv.agg(F.round(F.avg("test_auc"), 4).alias("cv_auc_mean"),
                    F.round(F.stddev_pop("test_auc"), 4).alias("cv_auc_std"))
    per_fold = cv.select(F.concat(F.lit("cv_auc_fold_"), F.col("fold")).alias("metric"), F.round("test_auc", 4).alias("value"))
    reports = evaluate_model(final, test)
    reports["folds"] = cv
    reports["metrics"] = ev.metrics_long(cv_row).unionByName(per_fold).unionByName(ev.metrics_long(reports["metrics"]))
    return final, reports


def blind_predictions(m: PipelineModel, unlabelled: DataFrame, id_col: str = "text_id") -> DataFrame:
    """``text_id, prediction, probability`` (4 dp) for documents without labels."""
    return md.rounded(md.predict(m, unlabelled, [id_col]))
