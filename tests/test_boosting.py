"""Boosted trees: splits against brute force, tasks against one task, stopping, restart, persistence."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexis.operators import boosting as bo
from lexis.operators.boosting import BoostedTrees, BoostedTreesModel, BoostParams
from lexis.session import shared_path


def rows_of(n=300, features=12, seed=0):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, features)) < 0.4, np.round(rng.random((n, features)), 2) + 0.01, 0.0)
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0) | (rng.random(n) < 0.1)).astype(float)
    return x, y


def frame(spark, x, y, held=None):
    rows = [(i, float(b), Vectors.sparse(x.shape[1], [(int(k), float(a[k])) for k in np.flatnonzero(a)]), bool(held[i]) if held is not None else False)
            for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "label", "features", "held"])


def brute_fit(x, y, p, w=None):
    """Exact greedy trees, every distinct value a threshold, zeros missing."""
    w = np.ones(len(y)) if w is None else w
    margin, out = np.zeros(len(y)), []
    score = lambda g, h: max(abs(g) - p.reg_alpha, 0) ** 2 / (h + p.reg_lambda)

    def grow(who, depth):
        gs, hs = g[who].sum(), h[who].sum()
        best = (max(p.gamma, bo.MIN_GAIN), None)
        if depth < p.max_depth:
            for f in range(x.shape[1]):
                v = x[who, f]
                for t in np.unique(v[v != 0]):
                    for miss in (False, True):
                        left = np.where(v == 0, miss, v <= t)
                        gl, hl = g[who][left].sum(), h[who][left].sum()
                        if min(hl, hs - hl) < p.min_child_weight or min(hl, hs - hl) <= 0:
                            continue
                        gain = score(gl, hl) + score(gs - gl, hs - hl) - score(gs, hs)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
        if best[1] is None:
            margin[who] += -np.sign(gs) * max(abs(gs) - p.reg_alpha, 0) / (hs + p.reg_lambda) * p.learning_rate
            return
        grow(who[best[1]], depth + 1)
        grow(who[~best[1]], depth + 1)

    for _ in range(p.n_estimators):
        prob = 1 / (1 + np.exp(-margin))
        g, h = w * (prob - y), w * prob * (1 - prob)
        grow(np.arange(len(y)), 0)
        out.append(margin.copy())
    return out


def scores(model, df):
    got = model.transform(df).select("id", vector_to_array("probability")[1].alias("p"), "prediction").orderBy("id").collect()
    assert all((r.p > 0.5) == (r.prediction == 1.0) for r in got)
    return np.array([r.p for r in got])


@pytest.mark.parametrize("extra", [{}, {"reg_alpha": 0.7, "reg_lambda": 2.5, "gamma": 0.4, "min_child_weight": 4.0}])
def test_trees_equal_exact_greedy_boosting(spark, extra):
    x, y = rows_of()
    p = BoostParams(n_estimators=5, max_depth=3, learning_rate=0.3, max_bin=256, **extra)
    model = BoostedTrees(p).fit(frame(spark, x, y))
    want = 1 / (1 + np.exp(-brute_fit(x, y, p)[-1]))
    assert np.allclose(scores(model, frame(spark, x, y)), want, atol=1e-9)


def test_several_tasks_grow_the_same_trees(spark, monkeypatch):
    x, y = rows_of(400)
    held = np.arange(400) % 5 == 0
    p = BoostParams(n_estimators=6, max_depth=4, subsample=0.8, colsample_bytree=0.7, early_stopping_rounds=6)
    df = frame(spark, x, y, held)
    one = BoostedTrees(p, heldCol="held").fit(df)
    monkeypatch.setattr(bo, "ENTRIES_PER_TASK", 500)
    many = BoostedTrees(p, heldCol="held").fit(df)
    assert np.allclose(scores(one, df), scores(many, df)) and np.allclose(one.aucs, many.aucs)


def test_weights_and_column_samples(spark):
    x, y = rows_of(200)
    p = BoostParams(n_estimators=4, max_depth=2, max_bin=256)
    weighted = frame(spark, x, y).withColumn("weight", F.when(F.col("label") == 1, 3.0).otherwise(1.0))
    model = BoostedTrees(p, weightCol="weight").fit(weighted)
    assert np.allclose(scores(model, weighted), 1 / (1 + np.exp(-brute_fit(x, y, p, np.where(y == 1, 3.0, 1.0))[-1])), atol=1e-9)
    few = BoostedTrees(BoostParams(n_estimators=30, max_depth=3, colsample_bytree=0.25)).fit(weighted)
    assert max(len(set(t.feature[t.feature >= 0])) for t in few.trees) <= 3
    assert len({f for t in few.trees for f in t.feature if f >= 0}) > 3


def test_no_tree_beyond_the_patience(spark):
    x, y = rows_of(500, seed=3)
    y = np.where(np.random.default_rng(1).random(500) < 0.25, 1 - y, y)
    held = np.arange(500) % 4 == 0
    p = BoostParams(n_estimators=200, max_depth=5, learning_rate=0.5, early_stopping_rounds=4)
    model = BoostedTrees(p, heldCol="held").fit(frame(spark, x, y, held))
    best = int(np.argmax(model.aucs)) + 1
    assert model.getNumTrees == best and model.grown == len(model.aucs) == min(best + 4, 200) and model.grown < 200
    score = scores(model, frame(spark, x, y, held))[held]
    pos, neg = score[y[held] == 1], score[y[held] == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(auc - max(model.aucs)) < 1e-12


class Alone:
    """A team of one task without Spark."""
    size, rank = 1, 0

    def exchange(self, parts):
        return parts

    def gather(self, part):
        return [part]


def test_only_the_lighter_child_of_a_split_is_summed(tmp_path, monkeypatch):
    x, y = rows_of(2000, 30, seed=5)
    at = [np.flatnonzero(a) for a in x]
    batch = pa.record_batch([pa.array(np.arange(len(y)), pa.uint64()), pa.array(y), pa.array(np.ones(len(y))), pa.array([False] * len(y)),
                             pa.array(at, pa.list_(pa.int32())), pa.array([a[k] for a, k in zip(x, at)], pa.list_(pa.float64()))],
                            names=["row", "label", "weight", "held", "indices", "values"])
    cuts = [np.unique(c[c != 0]) for c in x.T]
    offsets, summed, sums = np.append(0, np.cumsum([len(c) for c in cuts])), [], bo._sorted_sums
    monkeypatch.setattr(bo, "_sorted_sums", lambda key, *columns: summed.append(len(key)) or sums(key, *columns))
    p = BoostParams(n_estimators=4, max_depth=5, max_bin=256)
    rows = bo._Rows(iter([batch]), offsets, np.concatenate(cuts))
    found = bo._boost(Alone(), rows, offsets, np.concatenate(cuts), p, bo._Store(str(tmp_path)))
    margin = sum(t.leaves(np.where(x == 0, np.nan, x), {k: k for k in range(30)}) for t in found["trees"])
    assert ((margin > 0) == y).mean() > 0.85
    assert 0 < sum(summed) <= p.n_estimators * (p.max_depth - 1) * len(rows.entry_row) / 2


def test_restart_goes_on_from_saved_trees(spark, monkeypatch):
    x, y = rows_of(150)
    df, p = frame(spark, x, y), BoostParams(n_estimators=6, max_depth=3)
    whole = BoostedTrees(p).fit(df)
    folder = shared_path(spark, "boost")
    half = BoostedTrees(BoostParams(n_estimators=3, max_depth=3)).fit(df)
    bo._Store(folder).put("trees.json", json.dumps({"trees": [t.rows() for t in half.trees], "aucs": []}).encode())
    monkeypatch.setattr(bo, "shared_path", lambda s, name: folder)
    assert np.allclose(scores(BoostedTrees(p).fit(df), df), scores(whole, df))


def test_saved_model_scores_alike(spark):
    x, y = rows_of(120)
    df = frame(spark, x, y)
    model = BoostedTrees(BoostParams(n_estimators=3)).fit(df)
    path = shared_path(spark, "trees")
    model.write().overwrite().save(path)
    again = BoostedTreesModel.load(path)
    assert (scores(again, df) == scores(model, df)).all() and again.settings == model.settings


def test_edges(spark):
    dense = spark.createDataFrame([(0, 1.0, Vectors.dense([0.0, 2.0])), (1, 0.0, Vectors.dense([1.0, 0.0])), (2, None, Vectors.dense([5.0, 5.0])),
                                   (3, 0.0, Vectors.sparse(2, [], []))] * 8, ["id", "label", "features"])
    model = BoostedTrees(BoostParams(n_estimators=5, min_child_weight=0.1)).fit(dense)
    assert model.transform(dense).where("label is not null and label != prediction").count() == 0
    empty = spark.createDataFrame([(0, 1.0, Vectors.sparse(3, [], [])), (1, 0.0, Vectors.sparse(3, [], []))], ["id", "label", "features"])
    assert np.allclose(scores(BoostedTrees(BoostParams(n_estimators=2)).fit(empty), empty), 0.5)
    with pytest.raises(ValueError, match="no labelled rows"):
        BoostedTrees().fit(empty.limit(0))
    with pytest.raises(ValueError, match="validation rows"):
        BoostedTrees(BoostParams(early_stopping_rounds=3)).fit(empty)
    for bad in ({"reg_alpha": -1}, {"subsample": 0}, {"max_depth": 31}, {"colsample_bytree": 1.5}):
        with pytest.raises(ValueError):
            BoostParams(**bad)


def test_entries_are_binned_a_slice_at_a_time(monkeypatch):
    rng, n, nf = np.random.default_rng(4), 90, 11
    cuts = [np.sort(rng.random(k)) for k in rng.integers(0, 7, nf)]
    offsets, flat = np.append(0, np.cumsum([len(c) for c in cuts])), np.concatenate(cuts)
    index = [np.sort(rng.choice(nf + 2, rng.integers(0, 9), replace=False)).astype(np.int32) for _ in range(n)]
    value = [np.where(rng.random(len(i)) < 0.1, 0.0, rng.random(len(i)) * 1.2) for i in index]
    batch = pa.record_batch([pa.array(np.arange(n)), pa.array(np.ones(n)), pa.array(np.ones(n)), pa.array(np.zeros(n, bool)),
                             pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))],
                            names=["row", "label", "weight", "held", "indices", "values"])
    monkeypatch.setattr(bo, "SLICE_ENTRIES", 23)
    seen, bin_of = [], bo._bin_of
    monkeypatch.setattr(bo, "_bin_of", lambda f, *rest: seen.append(len(f)) or bin_of(f, *rest))
    rows = bo._Rows(iter([batch.slice(0, 37), batch.slice(37)]), offsets, flat)
    want = sorted((int(offsets[f] + min(np.searchsorted(cuts[f], x), len(cuts[f]) - 1)), r) for r in range(n)
                  for f, x in zip(index[r], value[r]) if x and f < nf and len(cuts[f]))
    assert list(zip(rows.entry_bin.tolist(), rows.entry_row.tolist())) == want and len(seen) > 10 and max(seen) <= 23
    assert rows.entry_bin.itemsize == rows.entry_row.itemsize == 4
    assert rows.edges.tolist() == [sum(b < o for b, _ in want) for o in offsets]
    listed = bo._Listed(type("Team", (), {"size": 1, "exchange": lambda s, p: p, "gather": lambda s, p: [p]})(),
                        (rows.entry_row, rows.entry_bin), np.repeat(np.arange(nf), np.diff(offsets)), np.ones(nf, bool), offsets)
    assert listed.row is rows.entry_row  # no second copy where every feature is listed
    team, node, g = type("Team", (), {"size": 1})(), rng.integers(0, 4, n), rng.integers(0, 9, n).astype(float)
    passed = np.zeros(len(flat), bool)
    passed[2] = True
    key, total = listed.nodes(team, node, 3, passed, g)
    sums = {}
    for b, r in want:
        if node[r] < 3 and b != 2:
            sums[int(node[r]) << bo.BIN | b] = sums.get(int(node[r]) << bo.BIN | b, 0) + g[r]
    assert dict(zip(key.tolist(), total.tolist())) == sums and (np.diff(key) > 0).all()
