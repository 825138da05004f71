"""Progressive Walsh-Hadamard search against plain k-means in integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexis.llm import walsh_clusters as wc


def brute(rows, dims, k, rounds, scale=1024, seed="3"):
    good = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(scale * c) < 2 ** 27 for c in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [list(x) for _, x in sorted(good, key=key)[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(x)[1] for _, x in good]
        for j in range(len(centres)):
            mine = [x for a, (_, x) in zip(at, good) if a == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *near(x)[::-1]) for i, x in good]
    by = {j: sum(d for _, a, d in found if a == j) for j in range(len(centres))}
    return [(i, j, d, by[j], sum(by.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, j, d in found]


def test_transform_is_exact_and_search_equals_brute_force():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-3000, 3000, (400, 64)), rng.integers(-3000, 3000, (8, 64))
    c[5] = c[2]  # a tie goes to the smaller number
    x[:8] = c
    h = wc.walsh(x)
    assert (wc.unwalsh(h) == 64 * x).all()
    assert (np.diff([int((np.diff(row) != 0).sum()) for row in wc.walsh(np.eye(64, dtype=np.int64)).T]) >= 0).all()  # coarse to fine
    best, far, work = wc.search(h, wc.walsh(c))
    full = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (far == full.min(axis=1)).all()
    assert work < 400 * 8 * 64 and best[5] == 2


def test_elimination_saves_work_on_smooth_vectors():
    rng = np.random.default_rng(2)
    centres = np.repeat(rng.integers(-4000, 4000, (8, 8)), 8, axis=1)
    x = np.repeat(centres, 50, axis=0) + rng.integers(-100, 100, (400, 64))
    assert wc.search(wc.walsh(x), wc.walsh(centres))[2] < 0.4 * 400 * 8 * 64


def test_large_numbers_leave_64_bits():
    x = np.array([[2 ** 27 - 1] * 64, [-(2 ** 27)] * 64], np.int64)
    best, far, _ = wc.search(wc.walsh(x), wc.walsh(x[::-1]))
    assert list(best) == [1, 0] and list(far) == [0, 0]
    best, far, _ = wc.search(wc.walsh(x[:1]), wc.walsh(x[1:]))
    assert far[0] == 64 * (2 ** 28 - 1) ** 2


def test_clusters_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(wc, "SLICE", 37)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(150, 8)))]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)] + [(7, [9.0] * 8), (7, [8.0] * 8), (None, [1.0] * 8), (None, [1.0] * 8)]
    rows += [(2000, None), (2001, [1.0] * 7), (2002, [1.0, None] + [0.0] * 6), (2003, [float("nan")] * 8), (2004, [float("-inf")] * 8),
             (2005, []), (2006, [1e30] * 8), (2007, [131000.0, -131000.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("distance", F.lit(0.5))
    got = sorted(map(tuple, wc.cluster(df, k=8, rounds=10, dims=8).collect()), key=str)
    assert got == sorted(brute(rows, 8, 8, 10), key=str)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]])
def test_fewer_vectors_than_centroids(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = wc.cluster(df, dims=2)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 2, 8, 10))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_dims_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        wc.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"), dims=6)
