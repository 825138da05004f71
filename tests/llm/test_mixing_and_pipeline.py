"""Budget fitting against brute force, mixing targets, and the pipeline's stages."""

import importlib.util
import itertools
import random
from collections import Counter

import numpy as np
import pytest

from lexis.llm import mixing
from lexis.llm.mixing import fit_budget, mix_sources, proportional


def test_fit_budget_is_the_best_sum():
    rnd = random.Random(8)
    for _ in range(60):
        sizes = np.array(sorted(rnd.sample(range(0, 40), 4)))
        counts = np.array([rnd.randrange(0, 4) for _ in sizes])
        budget = rnd.randrange(0, 150)
        take = fit_budget(sizes, counts, budget)
        assert ((0 <= take) & (take <= counts)).all() and (take * sizes).sum() <= budget
        if 0 < budget < (sizes * counts).sum():
            start = proportional(sizes, counts, budget, 42)
            assert (start <= counts).all() and (start * sizes).sum() <= budget
            best = max(sum(k * int(s) for k, s in zip(ks, sizes)) for ks in itertools.product(
                *[range(a, c + 1) for a, c in zip(start, counts)]) if sum(k * int(s) for k, s in zip(ks, sizes)) <= budget)
            assert (take * sizes).sum() == best
    big = fit_budget(np.arange(1, 3000), np.full(2999, 1000), 2_000_000_123)
    assert (big * np.arange(1, 3000)).sum() == 2_000_000_123


@pytest.mark.parametrize("each", [1, 5, 20])
@pytest.mark.parametrize("part", [0.1, 0.5, 0.85])
def test_taken_shares_do_not_follow_length(each, part):
    sizes, counts = np.arange(1, 2001), np.full(2000, each)
    budget = int(part * (sizes * counts).sum())
    take = fit_budget(sizes, counts, budget)
    assert (take * sizes).sum() == budget and (take <= counts).all()
    for quarter in np.split(np.arange(2000), 4):
        assert abs(take[quarter].sum() / counts[quarter].sum() - part) < 0.06
    if each == 1:  # the seed decides where shares are not whole
        assert any((fit_budget(sizes, counts, budget, seed=s) != take).any() for s in range(8))


def test_items_longer_than_the_table():
    sizes, counts = np.array([0, 70_000, 90_000, 1_000_000]), np.array([5, 3, 2, 2])
    take = fit_budget(sizes, counts, 1_200_000)
    assert (take <= counts).all() and 0 <= 1_200_000 - (take * sizes).sum() <= 1_000_000 and take[0] == 0


def water_fill(sizes, weights):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed.update({s: 2.0 * sizes[s] for s in over})


def test_targets_and_taken_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 4)
    rnd = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rnd.choice([1, 3, 7, 20]))), rnd.choice(["b", "a", "é", None, "zz"])) for i in range(300)]
    rows += [(400, None, "a"), (401, "", "empty"), (None, "x y", "a"), (5, "one two", "b"), (5, "one two", "b")]
    rows += [(500 + i, "hot words here", "hot") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water_fill(sizes, (3, 1, 2))
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for s in sizes:
        assert want[s] - 3 <= taken[s] <= want[s] + 1e-6
    again = mix_sources(df.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mix_sources(df.limit(0)).count() == 0


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_pipeline_stages(spark, sf):
    import corpus_pipeline
    from lexis.session import materialize
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, sf), "test-stage")
        assert 0.5 * before < docs.count() <= before, name
        before = docs.count()
        if i < 4:
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "minhash_near_dedup", "substring_dedup",
                                                      "benchmark_decontamination", "source_mixing"]


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_near_dedup_stage_keeps_one_row(spark):
    import corpus_pipeline
    rows = [(1, "a b c d e f g h", "en"), (2, "a b c d e f g h", "en"), (1, "a b c d e f g h", "de"), (3, "other words in here now ok", "en"),
            (None, "a b c d e f g h", "en"), (4, None, "en"), (5, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.minhash_near_dedup(spark, df, "")
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "3", "4", "5", "None"]
