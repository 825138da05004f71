"""Trial tables, the append-only trial journal (A10) and the consolidated
results document (A11).

Trial table schema: ``study, trial_id, state, value, params map<string,double>,
started, completed``.  ``trial_rows`` builds stand-in trials from the driver's
tables (one trial per document; study by language; failed when unlabelled);
it shapes input only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.operators.rank import bucketed_row_number
from lexis.sources.tables import table

# Journal operation codes and states (fixed format of the trial log).
OP_CREATE_STUDY, OP_START_TRIAL, OP_SET_PARAM, OP_FINISH_TRIAL = 0, 4, 5, 6
STATE_COMPLETE, STATE_FAIL = 1, 2
MAXIMIZE = 2
JOURNAL_SCHEMA = T.StructType([
    T.StructField("op_code", T.IntegerType()), T.StructField("worker_id", T.StringType()),
    T.StructField("study_name", T.StringType()), T.StructField("directions", T.ArrayType(T.IntegerType())),
    T.StructField("study_id", T.LongType()),
    T.StructField("trial_id", T.LongType()), T.StructField("param_name", T.StringType()),
    T.StructField("param_value_internal", T.DoubleType()), T.StructField("distribution", T.StringType()),
    T.StructField("state", T.IntegerType()), T.StructField("values", T.ArrayType(T.DoubleType())),
    T.StructField("datetime_start", T.StringType()), T.StructField("datetime_complete", T.StringType()),
])
EPOCH = "2024-01-01 00:00:00"


def trial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("_lab"))
    x = d.join(lab, "doc_id", "left")
    done = F.col("_lab").isNotNull()
    started = F.to_timestamp(F.lit(EPOCH)) + F.make_interval(secs=F.col("doc_id").cast("int"))
    return x.select(
        F.concat(F.lit("tfidf_"), F.col("lang")).alias("study"), F.col("doc_id").alias("trial_id"),
        F.when(done, "complete").otherwise("failed").alias("state"),
        F.when(done, F.round((F.col("n_chars") % 997) / 997.0, 6)).otherwise(F.lit(0.0)).alias("value"),
        F.create_map(F.lit("min_df"), (F.col("n_chars") % 5 + 1).cast("double"),
                     F.lit("max_df"), F.round(0.7 + (F.col("n_chars") % 30) / 100.0, 2)).alias("params"),
        started.alias("started"),
        (started + F.make_interval(secs=(F.col("n_chars") % 60).cast("int"))).alias("completed"))


def _numbered(rows: DataFrame, order: list[str], out: str, bucket: Column) -> DataFrame:
    """Position of each row in the total ``order``, from 0; ``bucket`` is a monotone
    function of the order, so each bucket is one window."""
    ranked = bucketed_row_number(rows.withColumn("_b", bucket), [], [F.asc(c) for c in order], "_b", "_n")
    return ranked.withColumn(out, (F.col("_n") - 1).cast("long")).drop("_b", "_n")


def write_journal(trials: DataFrame, path: str) -> str:
    """Trial rows -> journal lines in log order: studies are created by name, then
    every trial starts, gets its parameters and ends, trials by ``trial_id``.  As
    in the real log no line names its own new id: it is the line's position
    among the lines of its kind."""
    def ts(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")

    studies = trials.select("study").distinct()
    studies = studies.withColumn("study_id", F.row_number().over(Window.orderBy("study")) - 1)  # one row per study
    t = _numbered(trials, ["trial_id", "study"], "number", F.floor(F.col("trial_id") / 1024)).join(studies, "study")
    create = studies.select(F.lit(-1).cast("long").alias("_at"), F.col("study_id").cast("int").alias("_sub"),
                            F.lit(OP_CREATE_STUDY).alias("op_code"), F.col("study").alias("study_name"),
                            F.array(F.lit(MAXIMIZE)).alias("directions"))
    start = t.select(F.col("number").alias("_at"), F.lit(0).alias("_sub"), F.lit(OP_START_TRIAL).alias("op_code"), "study_id",
                     ts(F.col("started")).alias("datetime_start"))
    params = t.select(F.col("number").alias("_at"), F.lit(1).alias("_sub"), F.lit(OP_SET_PARAM).alias("op_code"),
                      F.col("number").alias("trial_id"), F.explode("params").alias("param_name", "param_value_internal"),
                      F.lit('{"name": "FloatDistribution", "attributes": {"step": null, "low": 0.0, "high": 10.0, "log": false}}')
                      .alias("distribution"))
    finish = t.select(F.col("number").alias("_at"), F.lit(2).alias("_sub"), F.lit(OP_FINISH_TRIAL).alias("op_code"),
                      F.col("number").alias("trial_id"),
                      F.when(F.col("state") == "complete", STATE_COMPLETE).otherwise(STATE_FAIL).alias("state"),
                      F.array("value").alias("values"), ts(F.col("completed")).alias("datetime_complete"))
    lines = create.unionByName(start, allowMissingColumns=True).unionByName(params, allowMissingColumns=True) \
        .unionByName(finish, allowMissingColumns=True).withColumn("worker_id", F.lit("w0"))
    lines.orderBy("_at", "_sub").drop("_at", "_sub").write.mode("overwrite").json(path)
    return path


def _in_log_order(lines: DataFrame, out: str) -> DataFrame:
    """Numbers lines by their order in the log: file, split, place in the split."""
    per = Window.partitionBy("_file", "_block").orderBy("_line")
    totals = lines.groupBy("_file", "_block").agg(F.count("*").alias("_c"))  # one row per split
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_file", "_block", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    return (lines.withColumn("_n", F.row_number().over(per) - 1).join(starts, ["_file", "_block"])
            .withColumn(out, F.col("_before") + F.col("_n")).drop("_n", "_before"))


def scan_journal(spark: SparkSession, path: str) -> DataFrame:
    """A10: journal lines -> trial table.  A study's id is the position of its create
    line, a trial's id the position of its start line, among all of the log.
    Parameters fold into a map per trial (bounded by the number of parameters)."""
    j = spark.read.schema(JOURNAL_SCHEMA).json(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    place = ["_file", "_block", "_line"]
    studies = _in_log_order(j.where(F.col("op_code") == OP_CREATE_STUDY).select("study_name", *place), "study_id").select(
        "study_id", F.col("study_name").alias("study"))
    starts = _in_log_order(j.where(F.col("op_code") == OP_START_TRIAL).select("study_id", "datetime_start", *place), "trial_id").select(
        "study_id", "trial_id", F.to_timestamp("datetime_start").alias("started"))
    params = (j.where(F.col("op_code") == OP_SET_PARAM).groupBy("trial_id")
              .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("param_name", "param_value_internal"))))
                   .alias("params")))
    ends = j.where(F.col("op_code") == OP_FINISH_TRIAL).select(
        "trial_id", F.when(F.col("state") == STATE_COMPLETE, "complete").otherwise("failed").alias("state"),
        F.element_at("values", 1).alias("value"), F.to_timestamp("datetime_complete").alias("completed"))
    return (starts.join(studies, "study_id").join(ends, "trial_id", "left").join(params, "trial_id", "left")
            .select("study", "trial_id", "state", "value", "params", "started", "completed"))


# One entry of the results document; cross-validation results of a cleaning
# variant are inside "optuna", those of a model entry beside "test".
METRICS = ("TP", "TN", "FP", "FN", "TPR", "FPR", "AUC", "precision", "recall", "F1")
_TEST = "struct<" + ",".join(f"{m}:double" for m in METRICS) + ">"
RESULTS_TYPE = (f"map<string,struct<test:{_TEST},cv_auc:double,best_cv_auc:double,best_params:map<string,string>,"
                "optuna:struct<best_cv_auc:double,best_params:map<string,string>>>>")


def write_results(results: DataFrame, path: str) -> str:
    """Consolidated results ``(entry, test_auc, cv_auc[, other metrics])`` -> one JSON
    object keyed by entry, a bounded document with one entry per variant or model."""
    have = [m for m in METRICS if m != "AUC" and m in results.columns]
    test = F.struct(F.col("test_auc").alias("AUC"), *have)
    model = F.col("entry").endswith("_optimization")
    value = F.struct(test.alias("test"), F.when(~model, F.struct(F.col("cv_auc").alias("best_cv_auc"))).alias("optuna"),
                     F.when(model, F.col("cv_auc")).alias("best_cv_auc"))
    doc = results.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("entry", value))), {"pretty": "true"}).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


def scan_results(spark: SparkSession, path: str) -> DataFrame:
    """Keyed JSON object (over any number of lines) -> one row per entry:
    ``entry, test_auc, cv_auc``, every other test metric and ``best_params``."""
    raw = spark.read.text(path, wholetext=True)
    m = raw.select(F.explode(F.from_json("value", RESULTS_TYPE)).alias("entry", "r"))
    cv = F.coalesce(F.col("r.optuna.best_cv_auc"), F.col("r.best_cv_auc"), F.col("r.cv_auc"))
    return m.select("entry", F.col("r.test.AUC").alias("test_auc"), cv.alias("cv_auc"),
                    *[F.col(f"r.test.{x}").alias(x) for x in METRICS if x != "AUC"],
                    F.coalesce("r.optuna.best_params", "r.best_params").alias("best_params"))
