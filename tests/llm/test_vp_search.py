"""Vantage-point search against brute force, with ties and bad vectors."""

import numpy as np
from pyspark.sql import functions as F

from lexis.llm import vp_search
from lexis.llm.vp_search import Tree, nearest


def brute(rows, asks, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            good.setdefault(i, np.array(v, np.float64))
    out = []
    for q in sorted(good):
        if not asks(q):
            continue
        found = []
        for i, v in good.items():
            if i != q and len(v) == len(good[q]):
                a = good[q]
                found.append((-round(float(a @ v / (np.linalg.norm(a) * np.linalg.norm(v))), 12), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


def test_exact_search_with_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(vp_search, "SHARD", 150)
    monkeypatch.setattr(vp_search, "BLOCK", 7)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(500)]
    rows += [(500 + i, [1.0, 0.5, 0.0, 0.0, 0.0, 0.25]) for i in range(60)]  # one common vector
    rows += [(1000, None), (1010, [0.0] * 6), (1020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1030, [float("nan")] * 6), (None, [1.0] * 6),
             (1040, [float("inf")] * 6), (1050, [1.0, 2.0]), (1060, [2.0, 4.0]), (1070, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    got = sorted(tuple(r) for r in nearest(df, F.col("vec_id") % 10 == 0, 5).collect())
    want = brute(rows, lambda q: q % 10 == 0, 5)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-11)
    assert nearest(df.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_pruned_tree_is_exact_and_factor_prunes():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8)) * 4
    unit = np.concatenate([c + rng.normal(size=(100, 8)) * 0.1 for c in centres])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids, query, own = np.arange(2000), unit[::40], np.arange(0, 2000, 40)
    want = query @ unit.T
    want[np.arange(50), own] = -np.inf
    want = np.sort(want, axis=1)[:, ::-1][:, :5]
    for size in (16, 64):
        vp_search.LEAF, old = size, vp_search.LEAF
        tree = Tree(unit)
        exact, loose = tree.nearest(query, ids, own, 5, 1.0)[1], tree.nearest(query, ids, own, 5, 3.0)[1]
        vp_search.LEAF = old
        assert np.allclose(exact, want)
        assert (np.isclose(loose, want)).mean() > 0.5


def test_very_long_and_very_short_vectors(spark, monkeypatch):
    monkeypatch.setattr(vp_search, "SHARD", 700)
    rng = np.random.default_rng(6)
    plain = rng.normal(size=(2000, 8))
    factor = np.ones(2000)
    factor[rng.choice(2000, 60, replace=False)] = np.repeat([2.0 ** -700, 2.0 ** 700, 2.0 ** -1000], 20)  # about 1e-211, 1e210, 1e-301
    lists = [nearest(spark.createDataFrame([(i, (v * f).tolist()) for i, (v, f) in enumerate(zip(plain, scale))], "vec_id long, embedding array<double>"),
                     F.col("vec_id") % 50 == 0, 5).collect() for scale in (np.ones(2000), factor)]
    assert sorted(map(tuple, lists[0])) == sorted(map(tuple, lists[1]))
    unit = plain / np.linalg.norm(plain, axis=1, keepdims=True)
    every = unit[::50] @ unit.T
    every[np.arange(40), np.arange(0, 2000, 50)] = -np.inf
    got = {(r.query_id, r.rank): r.vec_id for r in lists[1]}
    assert all(got[q * 50, r + 1] == i for q, row in enumerate(every) for r, i in enumerate(np.argsort(-row)[:5]))


def test_cosines_closer_than_rounding_keep_their_order(spark):
    turn = [1e-7 * (9 - i) for i in range(9)]  # cosines 1 - turn^2 / 2, at most 4e-13 apart
    rows = [(0, [1.0, 0.0])] + [(i + 1, [1.0, t]) for i, t in enumerate(turn)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r.vec_id for r in nearest(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert got == [9, 8, 7, 6, 5]
