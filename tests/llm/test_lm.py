"""Kneser-Ney counts and probabilities against a dictionary version."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexis.llm import lm


def brute(train, texts):
    toks = [[w for w in (t or "").encode().lower().split()] + ["</s>"] for t in train]
    uni = Counter(w for t in toks for w in t)
    pairs = Counter((v, w) for t in toks for v, w in zip(["<s>", *t], t))
    fans = Counter(w for _, w in pairs)
    heads = defaultdict(list)
    total = Counter()
    for (v, w), c in pairs.items():
        heads[v].append(c)
        total[v] += c

    def cuts(counts):
        return [0.0, *lm.discounts([sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)])]

    d2, d1 = cuts(pairs.values()), cuts(fans.values())
    n, types = sum(uni.values()), len(uni)
    free = sum(d1[min(c, 3)] for c in fans.values()) / max(len(pairs), 1)

    def p(v, w):
        p1 = max(fans[w] - d1[min(fans[w], 3)], 0) / max(len(pairs), 1) + free / (types + 1)
        if not total[v]:
            return p1
        c = pairs[v, w]
        return (max(c - d2[min(c, 3)], 0) + sum(d2[min(x, 3)] for x in heads[v]) * p1) / total[v]

    out = []
    for t in texts:
        words = [w for w in (t or "").encode().lower().split()] + ["</s>"]
        out.append((len(words), sum(uni[w] > 0 for w in words), sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (types + 1))) for w in words),
                    sum(math.log10(p(v, w)) for v, w in zip(["<s>", *words], words))))
    vocab = [*uni, "<unknown>"]
    for v in ["<s>", *list(uni)[:5]]:
        assert sum(p(v, w) for w in vocab) == pytest.approx(1.0)
    return n, out


@pytest.mark.parametrize("shard_bytes", [10**9, 700])
def test_model_matches_dictionary_version(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(lm, "BYTES_PER_SHARD", shard_bytes)
    monkeypatch.setattr(lm, "BUFFER", 300)
    rnd = random.Random(1)
    words = ["The", "cat", "sät", "on", "mat"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(words[: rnd.choice([6, 65])]) for _ in range(rnd.randrange(1, 40))) for _ in range(120)]
    texts += [None, "", " \n", "never seen words", "the the the", "x" * 9000 + " cat"]
    train, n = texts[:100] + [None], None
    df = spark.createDataFrame([(t,) for t in train], "text string").repartition(3)
    model = lm.train(df)
    n, want = brute(train, texts)
    assert model.total == n
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in lm.score(rows, model, ["doc_id"]).collect()}
    for i, (tokens, known, base, score) in enumerate(want):
        assert (got[i].n_tokens, got[i].n_known) == (tokens, known)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        assert got[i].score == pytest.approx(score, rel=1e-9)


def test_untrained_model_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = lm.train(none)
    assert model.total == 0
    assert lm.score(none, model, ["doc_id"]).count() == 0
    row = lm.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model, ["doc_id"]).first()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)


def test_held_out_documents_score_above_the_base(spark, sf):
    from lexis.llm.queries import QUERIES
    rows = QUERIES["op4_lm_scoring"](spark, sf).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert np.isfinite([r.score for r in rows]).all()


def test_split_visits_only_shards_that_occur():
    import numpy as np
    from lexis.llm import lm
    shard = np.array([5, 2, 5, 39_999, 2, 0])
    assert [(s, at.tolist()) for s, at in lm._split(shard, 1 << 60)] == [(0, [5]), (2, [1, 4]), (5, [0, 2]), (39_999, [3])]
    assert list(lm._split(shard[:0], 1 << 60)) == []
