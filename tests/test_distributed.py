"""Distributed helpers equal their single-window / brute-force definitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexis.operators import evaluate as ev
from lexis.operators import rank as rk
from lexis.operators import split as sp


def test_bucketed_row_number_matches_window(spark):
    rows = [(i, random.Random(i).choice([0, 1, 1, 1])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label int").withColumn("k", F.md5(F.col("id").cast("string")))
    got = rk.bucketed_row_number(df.withColumn("_b", rk.hex_prefix_bucket("k", 2)), ["label"],
                                 [F.asc("k"), F.asc("id")], "_b", "rn").select("id", "rn")
    ref = df.select("id", F.row_number().over(Window.partitionBy("label").orderBy("k", "id")).cast("long").alias("rn"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_top_k_per_group(spark):
    rows = [(g, f"t{i}", (i * 7919) % 101) for g in (0, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, term string, n int")
    got = rk.top_k_per_group(df, ["g"], [F.desc("n"), F.asc("term")], 7, F.xxhash64("term"), 16)
    for g in (0, 1):
        mine = [r.term for r in got.where(F.col("g") == g).orderBy("rank").collect()]
        brute = [t for _, t, _ in sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:7]]
        assert mine == brute


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_matches_brute_force(spark):
    r = random.Random(7)
    pairs = [(r.randint(0, 1), round(r.random(), 2)) for _ in range(800)]
    df = spark.createDataFrame(pairs, "label int, probability double")
    got = ev.roc_auc(df, n_buckets=16).first()["auc"]
    assert abs(got - brute_auc(pairs)) < 1e-12


def test_golden_metrics(spark):
    y_true = [1, 1, 1, 1, 1, 0, 0, 0, 0, 0]
    y_pred = [1, 1, 1, 0, 0, 0, 0, 0, 1, 1]
    proba = [0.9, 0.8, 0.7, 0.4, 0.3, 0.2, 0.1, 0.35, 0.6, 0.65]
    df = spark.createDataFrame(list(zip(y_true, y_pred, proba)), "label int, prediction int, probability double")
    m = ev.binary_metrics(df).first().asDict()
    assert (m["tp"], m["fn"], m["tn"], m["fp"]) == (3, 2, 3, 2)
    assert m["tpr"] == 0.6 and m["fpr"] == 0.4 and m["precision"] == 0.6 and m["recall"] == 0.6 and m["f1"] == 0.6
    perfect = spark.createDataFrame([(0, 0, .1), (0, 0, .2), (1, 1, .9), (1, 1, .95)],
                                    "label int, prediction int, probability double")
    pm = ev.binary_metrics(perfect).first()
    assert pm["auc"] == 1.0 and pm["f1"] == 1.0


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.9)], "label int, probability double")
    assert ev.roc_auc(df).first()["auc"] is None


def test_split_quota_and_folds(spark):
    assert sp.largest_remainder([(0, 732), (1, 784)], 304) == {0: 147, 1: 157}
    rows = [(i, 1 if i % 3 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "text_id long, label int")
    s = sp.stratified_split(df, test_size=0.2)
    counts = dict(((r.label, r.split), r["count"]) for r in s.groupBy("label", "split").count().collect())
    assert counts[(0, "test")] + counts[(1, "test")] == 200
    assert abs(counts[(0, "test")] - 0.2 * 334) <= 1
    assert sp.leak_check(s).first()["n_overlap"] == 0
    f = sp.stratified_kfold(df, n_splits=5)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_exact_percentiles_equal_percentile(spark):
    r = random.Random(5)
    rows = [("a", r.randrange(10**9)) for _ in range(3001)] + [("b", r.choice([1, 1, 1, 2, 50])) for _ in range(400)]
    rows += [("c", 7), ("d", None), (None, 3)]
    df = spark.createDataFrame(rows, "g string, x long")
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.95, 1.0]
    got = {x.g: x.p for x in rk.exact_percentiles(rk.value_counts(df, ["g"], "x"), ["g"], probs, "p", 16).collect()}
    want = df.dropna().groupBy("g").agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("p")).collect()
    assert set(got) == {"a", "b", "c"}
    for row in want:
        assert all(abs(x - y) < 1e-6 for x, y in zip(got[row.g], row.p))
    empty = rk.value_counts(df.limit(0), ["g"], "x")
    assert rk.exact_percentiles(empty, ["g"], probs).count() == 0


def test_length_tables_equal_direct_aggregates(spark):
    from lexis.operators import profile as pr
    r = random.Random(9)
    rows = [(r.choice([0, 1, None]), r.randrange(1, 5000), r.choice([3, 4, 5, 900])) for _ in range(1500)]
    lens = spark.createDataFrame(rows, "label int, n_chars int, n_tokens int")
    got = {x.measure: x for x in pr.length_describe(lens).collect()}
    for m in ("n_chars", "n_tokens"):
        want = lens.agg(F.count(m).alias("count"), F.round(F.avg(m), 1).alias("mean"), F.round(F.stddev_samp(m), 1).alias("std"),
                        F.round(F.percentile(m, 0.95), 1).alias("p95"), F.max(m).cast("double").alias("max")).first()
        assert (got[m]["count"], got[m]["mean"], got[m]["std"], got[m]["p95"], got[m]["max"]) == tuple(want)
    none = {x.measure: x for x in pr.length_describe(lens.limit(0)).collect()}
    assert set(none) == {"n_chars", "n_tokens"} and none["n_chars"]["count"] == 0 and none["n_chars"]["p50"] is None
    box = {x.label: x for x in pr.length_box_by_class(lens).collect()}
    for label in (0, 1):
        mine = sorted(n for y, _, n in rows if y == label)
        q1, q3 = box[label].q1, box[label].q3
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert box[label].n_outliers == sum(n < low or n > high for n in mine)
        assert box[label].whisker_hi == max(n for n in mine if n <= high)
    assert set(box) == {0, 1}


def test_running_best_does_not_depend_on_buckets(spark):
    from lexis.operators.search import running_best
    r = random.Random(4)
    rows = [(s, i * 10**6, round(r.random(), 3)) for s in ("x", "y") for i in range(300)] + [("z", 5, 0.0)]
    df = spark.createDataFrame(rows, "study string, trial_id long, value double")
    want, best = {}, {}
    for s, t, v in sorted(rows):
        best[s] = max(best.get(s, v), v)
        want[s, t] = best[s]
    for n in (1, 8, 256):
        assert {(x.study, x.trial_id): x.running_best for x in running_best(df, n).collect()} == want
    assert running_best(df.limit(0)).count() == 0


def test_folds_of_wide_rows(spark, capsys):
    rows = [(i % 400, i % 2, f"text {i}") for i in range(800)] + [(None, 1, "no id"), (7000, None, "no label")]
    df = spark.createDataFrame(rows, "text_id long, label int, text string")
    wide = sp.stratified_kfold(df, n_splits=5)
    narrow = {(x.text_id, x.label): x.fold for x in sp.stratified_kfold(df.select("text_id", "label"), n_splits=5).collect()}
    got = wide.collect()
    assert wide.columns == ["text_id", "label", "text", "fold"] and len(got) == 800
    assert all(narrow[x.text_id, x.label] == x.fold for x in got)  # rows that repeat an id share its fold
    wide.explain()
    plan = capsys.readouterr().out
    assert "Window" in plan and not any("Window" in line and "text#" in line for line in plan.splitlines())


def test_unknown_null_strategy_raises(spark):
    import pytest

    from lexis.operators import nulls
    with pytest.raises(ValueError):
        nulls.handle_missing(spark.createDataFrame([("a",)], "text string"), strategy="guess")
