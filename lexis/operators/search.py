"""Hyper-parameter search as a trial table.

A trial's parameters are a pure function of ``(seed, study, trial_id, name)``
through an md5 digest, so any engine regenerates the plan and a resumed run
plans exactly the trials that are missing.  Completed trials live in a trial
table (Parquet below the shared folder, one ``run_id`` partition per run —
nothing is deleted: a fresh start is a new ``run_id``, a resume the old one).  Reports over the trial table are aggregates keyed by
study; the per-study running best uses the bucketed running maximum so one
large study is not one task.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from threading import Lock

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexis.operators.rank import bucketed_running_max, quantile_bucket

HEX13 = float(16 ** 13)

# Fixed values that must match: search spaces as (kind, low, high) or ("cat", choices).
VECTORIZER_SPACE = {
    "ngram_idx": ("cat", [0, 1, 2]),          # -> ngram (1,1), (1,2), (1,3)
    "min_df": ("int", 1, 5),
    "max_df": ("float", 0.70, 0.99),
    "sublinear_tf": ("cat", [True, False]),
    "max_features": ("cat", [5000, 10000, 20000, 50000]),
}
GBT_SPACE = {
    "n_estimators": ("int", 100, 1500), "max_depth": ("int", 3, 10), "learning_rate": ("logf", 0.005, 0.3),
    "subsample": ("float", 0.6, 1.0), "colsample_bytree": ("float", 0.6, 1.0), "gamma": ("float", 0.0, 5.0),
    "min_child_weight": ("int", 1, 10), "reg_alpha": ("logf", 1e-8, 10.0), "reg_lambda": ("logf", 1e-8, 10.0),
}
SVM_SPACE = {"C": ("logf", 0.01, 100.0), "gamma": ("logf", 1e-4, 1.0)}
LR_SPACE = {"C": ("logf", 0.001, 100.0), "max_iter": ("int", 200, 2000)}
MODEL_SPACES = {"gbt": GBT_SPACE, "rff_svc": SVM_SPACE, "logreg": LR_SPACE}
DEFAULT_TRIALS = 30
PLAN_CHUNK = 4096
FLOAT_DP = 6


def uniform(seed: str, study: Column, trial: Column, name: str) -> Column:
    """u in [0, 1) from the first 13 hex digits of md5('seed:study:trial:name')."""
    key = F.concat_ws(":", F.lit(str(seed)), study, trial.cast("string"), F.lit(name))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(HEX13)


def suggest(spec, u: Column) -> Column:
    """Bounds inclusive for ints; floats rounded to 6 dp; log-uniform for ``logf``."""
    kind = spec[0]
    if kind == "cat":
        choices = spec[1]
        return F.element_at(F.array(*[F.lit(c) for c in choices]), (F.floor(u * len(choices)) + 1).cast("int"))
    lo, hi = spec[1], spec[2]
    if kind == "int":
        return (F.lit(lo) + F.floor(u * (hi - lo + 1))).cast("int")
    if kind == "float":
        return F.round(F.lit(float(lo)) + u * (hi - lo), FLOAT_DP)
    if kind == "logf":
        return F.round(F.exp(F.lit(math.log(lo)) + u * (math.log(hi) - math.log(lo))), FLOAT_DP + 2)
    raise ValueError(f"unknown parameter kind {kind!r}")


def trial_plan(studies: DataFrame, wanted: Column | int, space: dict, seed: str = "42") -> DataFrame:
    """Trials 0..wanted-1 for every study row, exploded in chunks so that no
    row holds the whole plan of a large study."""
    w = F.lit(wanted) if isinstance(wanted, int) else wanted
    chunks = studies.select("study", w.cast("long").alias("_w")).where("_w > 0").select(
        "study", "_w", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_w") - 1) / PLAN_CHUNK))).alias("_c"))
    first = F.col("_c") * PLAN_CHUNK
    plan = chunks.select("study", F.explode(F.sequence(first, F.least(first + PLAN_CHUNK, F.col("_w")) - 1)).alias("trial_id"))
    return plan.select("study", "trial_id",
                       *[suggest(spec, uniform(seed, F.col("study"), F.col("trial_id"), name)).alias(name)
                         for name, spec in space.items()])


def remaining(plan: DataFrame, trials: DataFrame) -> DataFrame:
    """I8: planned trials without a recorded one.  A failed trial is recorded (with
    value 0.0) and not run again: its parameters would be the same."""
    return plan.join(trials.select("study", "trial_id").distinct(), ["study", "trial_id"], "left_anti")


def best_trial(trials: DataFrame) -> DataFrame:
    """Per study trial count, completed count, best value and its trial (ties -> smaller id)."""
    best = F.max(F.when(F.col("state") == "complete", F.struct(F.col("value"), (-F.col("trial_id")).alias("neg_id"))))
    return (trials.groupBy("study")
            .agg(F.count(F.lit(1)).alias("n_trials"), F.count_if(F.col("state") == "complete").cast("long")
                 .alias("n_completed"), best.alias("_b"))
            .select("study", "n_trials", "n_completed", (-F.col("_b.neg_id")).alias("best_trial_id"),
                    F.col("_b.value").alias("best_value")))


def running_best(trials: DataFrame, n_buckets: int = 256) -> DataFrame:
    """Best value so far after each trial, in trial order, per study.

    Trials are cut into at most ``n_buckets`` buckets at approximate quantiles of
    their ids, so the broadcast offsets do not grow with the trials."""
    t = quantile_bucket(trials, "trial_id", "_b", n_buckets)
    return bucketed_running_max(t, ["study"], [F.asc("trial_id")], "_b", "value", "running_best").drop("_b") \
        .select("study", "trial_id", "value", "running_best")


def best_params(trials: DataFrame) -> DataFrame:
    """Parameters of each study's best trial: ``study, params``."""
    b = best_trial(trials).select("study", "best_trial_id")
    return trials.join(b, (trials["study"] == b["study"]) & (trials["trial_id"] == b["best_trial_id"]), "left_semi") \
        .select("study", "params")


def overlay(fixed: Column, best: Column) -> Column:
    """The best parameters replace, the fixed keys fill in (no repeated key)."""
    return F.map_concat(F.map_filter(fixed, lambda k, v: ~F.array_contains(F.map_keys(best), k)), best)


def is_model_entry(entry: Column) -> Column:
    return entry.endswith("_optimization")


def winner_variant(results: DataFrame, by: str = "cv_auc") -> DataFrame:
    """Best variant among non-model entries by ``cv_auc`` (default) or ``test_auc``."""
    if by not in ("cv_auc", "test_auc"):
        raise ValueError("by must be 'cv_auc' or 'test_auc'")
    cand = results.where(~is_model_entry(F.col("entry")))
    return cand.agg(F.max(F.struct(F.col(by), F.col("entry"))).alias("_w")).where(F.col("_w").isNotNull()).select(
        F.col("_w.entry").alias("winner"), F.lit(by).alias("by"), F.col(f"_w.{by}").alias("value"))


def variant_leaderboard(results: DataFrame, order: list[str]) -> DataFrame:
    """Variants in display order with rank by test AUC, winner flag and AUC range.
    The window runs over the handful of variant rows only."""
    spark: SparkSession = results.sparkSession
    disp = spark.createDataFrame([(v, i) for i, v in enumerate(order)], "entry string, display_order int")
    v = results.where(~is_model_entry(F.col("entry"))).join(disp, "entry")
    w = Window.orderBy(F.desc("test_auc"))
    return v.select("entry", "display_order", "test_auc", "cv_auc",
                    F.rank().over(w).cast("long").alias("rank"),
                    (F.rank().over(w) == 1).alias("is_winner"),
                    F.round(F.max("test_auc").over(Window.partitionBy()) - F.min("test_auc").over(Window.partitionBy()),
                            6).alias("auc_range"))


def model_leaderboard(results: DataFrame) -> DataFrame:
    """Model entries ranked by test AUC; when there is none, the stage-1 winner stands in."""
    models = results.where(is_model_entry(F.col("entry"))).select(
        F.regexp_replace("entry", "_optimization$", "").alias("model"), "test_auc", "cv_auc", F.lit("model").alias("kind"))
    fallback = winner_variant(results, "test_auc").select(F.col("winner").alias("model"), F.col("value").alias("test_auc"),
                                                         F.lit(None).cast("double").alias("cv_auc"),
                                                         F.lit("stage1_winner").alias("kind"))
    both = models.unionByName(fallback)  # one row per model entry plus one: a window over it is tiny
    n_models = F.count_if(F.col("kind") == "model").over(Window.partitionBy())
    chosen = both.withColumn("_n", n_models).where((F.col("kind") == "model") | (F.col("_n") == 0)).drop("_n")
    return chosen.select("model", "kind", "test_auc", "cv_auc",
                         F.rank().over(Window.orderBy(F.desc("test_auc"))).cast("long").alias("rank"))


def stage_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """I16: per metric ``after - before`` (null when either side is missing)."""
    b = before.select("metric", F.col("value").alias("before"))
    a = after.select("metric", F.col("value").alias("after"))
    return b.join(a, "metric", "full_outer").select(
        "metric", "before", "after", F.round(F.col("after") - F.col("before"), 6).alias("delta"))


TRIAL_SCHEMA = ("study string, trial_id long, state string, value double, params map<string,double>, "
                "started timestamp, completed timestamp, run_id string")
# What a bad parameter set raises; anything else (a lost cluster, a missing file) ends the search.
TRIAL_ERRORS = (ValueError, ArithmeticError, IllegalArgumentException)


def recorded(spark: SparkSession, table_path: str, run_id: str) -> DataFrame:
    """Trials of one run, an empty table before the first."""
    try:
        return spark.read.schema(TRIAL_SCHEMA).parquet(table_path).where(F.col("run_id") == run_id)
    except AnalysisException:
        return spark.createDataFrame([], TRIAL_SCHEMA)


def run_search(spark: SparkSession, plan: DataFrame, objective: Callable[[str, dict], float], table_path: str,
               run_id: str | None = None, n_trials: int = DEFAULT_TRIALS, timeout_sec: float | None = None,
               parallelism: int = 2) -> DataFrame:
    """Evaluate ``objective(study, params)`` for the first ``n_trials``
    planned trials of every study that ``run_id`` has not recorded yet (so a
    stopped search resumes), a few at a time, until the time budget runs out.
    Each finished trial is appended to the trial table; a trial whose
    parameters fail counts as complete with value 0.0."""
    run_id = run_id or uuid.uuid4().hex[:8]
    due = remaining(plan.where(F.col("trial_id") < n_trials), recorded(spark, table_path, run_id))
    rows = due.orderBy("trial_id", "study").collect()  # at most n_trials per study
    t0, writing = time.time(), Lock()

    def one(row) -> None:
        if timeout_sec is not None and time.time() - t0 >= timeout_sec:
            return
        params = {k: v for k, v in row.asDict().items() if k not in ("study", "trial_id")}
        started = datetime.now(timezone.utc)
        try:
            value = float(objective(row["study"], params))
        except TRIAL_ERRORS:
            value = 0.0
        rec = spark.createDataFrame([(row["study"], int(row["trial_id"]), "complete", value, {k: float(v) for k, v in params.items()},
                                      started, datetime.now(timezone.utc), run_id)], TRIAL_SCHEMA)
        with writing:  # appends to one folder must not overlap
            rec.coalesce(1).write.mode("append").partitionBy("run_id").parquet(table_path)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(one, rows))
    return recorded(spark, table_path, run_id)
