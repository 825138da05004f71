"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexis.llm import whitening as wh
from lexis.llm.queries import QUERIES
from lexis.llm.registry import table


def brute(rows, components=16):
    """Rows ``{id: ...}`` by numpy from all vectors that take part."""
    good = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) and abs(c) < 2.0 ** 47 for c in v)]
    sizes = [len(x) for _, x in good]
    if not sizes:
        return {}, 0
    dim = min(set(sizes), key=lambda s: (-sizes.count(s), s))
    good = [(i, x) for i, x in good if len(x) == dim]
    distinct = sorted({tuple(x) for _, x in good})
    n, total = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, total)] for x in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-11 * max(values[0], 0)).sum()))
    out = []
    for i, x in good:
        d = [n * c - s for c, s in zip(x, total)]
        out.append((i, sum(c * c for c in d), (np.array(d) / n) @ vectors[:, :k] / np.sqrt(values[:k])))
    return out, (n, values[:k] / values.sum())


def check(spark, rows, df=None, components=16):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>") if df is None else df
    got = wh.whiten(df, components).collect()
    want, shape = brute(rows, components)
    assert len(got) == sum(len(w[2]) for w in want)
    if not want:
        return got
    n, shares = shape
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
        assert r.n == n and abs(r.explained / shares[r.component - 1] - 1) < 1e-6 and r.identity_error <= 1e-4
    signs = None
    for i, deviation, white in want:
        mine = sorted(by.get(i, []), key=lambda r: r.component)[:len(white)]
        assert all(r.deviation == deviation for r in mine)
        values = np.array([r.whitened for r in mine])
        if signs is None and np.abs(white).min(initial=1) > 1e-3:
            signs = np.sign(values * white)
        if signs is not None:
            assert np.allclose(values * signs, white, rtol=0, atol=1e-6)
    return got


def test_given_table_against_numpy(spark, sf):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in table(spark, sf, "embeddings").select("vec_id", "embedding").collect()]
    got = check(spark, rows, table(spark, sf, "embeddings"))
    assert len(got) == 16 * len(rows) and {r.component for r in got} == set(range(1, 17))


def test_wide_vectors_need_the_filter(spark):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.normal(size=(80, 80)))[0]
    data = (rng.normal(size=(600, 80)) * np.geomspace(40, 2, 80)) @ basis
    check(spark, [(i, v) for i, v in enumerate(data.tolist())])


def test_copies_nulls_and_odd_lengths(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK_BYTES", 400)
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(40, 5)) * [9, 7, 5, 3, 2]).tolist())]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(30)]  # a group of copies counts once
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [1.0, float("inf"), 0.0, 0.0, 0.0]),
             (205, [1.0, 2.0]), (206, [1e300, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("component", F.lit(0.5))
    got = check(spark, rows, df)
    assert {r.vec_id for r in got} == set(range(40)) | set(range(100, 130))
    assert len({(r.whitened, r.deviation) for r in got if r.vec_id >= 100 and r.component == 1}) == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]])
def test_no_spread_has_no_component(spark, rows):
    assert wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_rank_below_the_components_and_null_ids(spark):
    rows = [(None, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 0.0]), (7, [3.0, 3.0, 0.0])]
    got = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == [("7", 1), ("None", 1), ("None", 1)]
    assert all(abs(r.explained - 1) < 1e-12 for r in got)


def test_deviations_beyond_64_bits_are_exact_inside():
    centre = wh.Centre(10 ** 7, [10 ** 7 * (1 << 52), 0])
    x = np.array([[(1 << 52) + 3, 4], [1 << 51, 0]], np.int64)
    assert centre.squares(x) == [(3 * 10 ** 7) ** 2 + (4 * 10 ** 7) ** 2, (10 ** 7 * (1 << 51)) ** 2]
    assert np.allclose(centre.centred(x)[0], [3.0, 4.0])


def test_close_eigenvalues_are_resolved():
    rng = np.random.default_rng(8)
    basis = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    spectrum = np.concatenate([np.linspace(1.02, 1.0, 16), np.linspace(0.99, 0.1, 104)])
    matrix = (basis * spectrum) @ basis.T
    values, vectors = wh.subspace(lambda q: matrix @ q, 120, 16)
    assert np.allclose(values, spectrum[:16], rtol=1e-12)
    assert np.allclose(np.abs((vectors * basis[:, :16]).sum(axis=0)), 1, atol=1e-9)


def test_query_is_the_operator(spark, sf):
    assert QUERIES["op11_embedding_whitening"](spark, sf).columns[:3] == ["vec_id", "component", "n"]
