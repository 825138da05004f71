"""TF-IDF against a dictionary version, and the shape of its plans."""

import math
import re
from collections import Counter

import pytest

from lexis.operators import tfidf as tf
from lexis.operators.tfidf import SublinearTf, TfidfConfig

TEXTS = ["the cat sat on the mat", "the dog sat", "", None, "cat cat cat dog bird", "bird-song the the", "a b c", "zz zz zz"]


def by_hand(texts, cfg):
    lo, hi = cfg.ngram_range
    docs = []
    for t in texts:
        w = re.findall(r"\b\w\w+\b", (t or "").lower(), re.ASCII)  # cleaned text is ASCII
        docs.append(Counter(" ".join(w[i:i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)))
    n = len(docs)
    df, ttf = Counter(t for d in docs for t in d), sum(docs, Counter())
    low = cfg.min_df if isinstance(cfg.min_df, int) else cfg.min_df * n
    high = cfg.max_df if isinstance(cfg.max_df, int) else cfg.max_df * n
    kept = sorted((t for t in df if low <= df[t] <= high), key=lambda t: (-ttf[t], t))[:cfg.max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in sorted(kept)}
    out = {}
    for i, d in enumerate(docs):
        w = {t: ((1 + math.log(c)) if cfg.sublinear_tf else c) * idf[t] for t, c in d.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): (list(idf).index(t), x / norm) for t, x in w.items()})
    return out


@pytest.mark.parametrize("cfg", [
    TfidfConfig(max_df=1.0), TfidfConfig(max_df=1.0, max_features=None), TfidfConfig((1, 2), 1, 1.0, True, 9),
    TfidfConfig((2, 3), 1, 0.9, True, None), TfidfConfig((1, 1), 2, 0.9, False, 3)])
def test_weights_equal_the_dictionary_version(spark, cfg):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)
    _, w = tf.fit_transform(docs, "id", "text", cfg)
    got = {(r["id"], r["term"]): (r["index"], r["tfidf"]) for r in w.collect()}
    want = by_hand(TEXTS, cfg)
    assert got.keys() == want.keys()
    for key, (index, value) in want.items():
        assert got[key][0] == index and got[key][1] == pytest.approx(value, rel=1e-12)


def test_counts_move_no_document_and_vectors_need_no_python(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    cfg = TfidfConfig((1, 2), 1, 1.0, True, 9)
    counted = tf.doc_freq(tf.term_freq(docs, "id", "text", cfg))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(term" in plan
    vocab, words = tf.fit(docs, "id", "text", cfg)
    made = tf.vectors(words, vocab, cfg)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    rows = {r.id: r.features for r in made.collect()}
    assert len(rows) == len(TEXTS) and rows[3].size == 9 and rows[3].numNonzeros() == 0


def test_new_documents_and_empty_vocabulary(spark):
    cfg = TfidfConfig(max_df=1.0, max_features=50)
    docs = spark.createDataFrame([(1, "aa bb"), (2, "bb cc")], "id long, text string")
    vocab, _ = tf.fit(docs, "id", "text", cfg)
    new = spark.createDataFrame([(7, "aa zz"), (8, "zz"), (9, None)], "id long, text string")
    assert [(r.id, r.term, r.tfidf) for r in tf.transform(new, vocab, "id", "text", cfg).collect()] == [(7, "aa", 1.0)]
    with pytest.raises(ValueError, match="empty vocabulary"):
        tf.fit(spark.createDataFrame([(1, "a"), (2, None)], "id long, text string"), "id", "text", cfg)


def test_sublinear_keeps_zero_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.sparse(4, [1, 3], [1.0, 7.0]),), (Vectors.sparse(4, [], []),), (Vectors.dense([0.0, 2.0]),)]
    got = [r.o for r in SublinearTf(inputCol="v", outputCol="o").transform(spark.createDataFrame(rows, ["v"])).collect()]
    assert got[0].toArray().tolist() == [0, 1, 0, 1 + math.log(7)] and got[0].numNonzeros() == 2
    assert got[1].numNonzeros() == 0 and got[2].toArray().tolist() == [0, 1 + math.log(2)]
