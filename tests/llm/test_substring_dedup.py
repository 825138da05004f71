"""Substring removal against a brute-force count of word windows."""

import hashlib
import random
from collections import Counter

import duckdb

from lexis.llm import substring_dedup
from lexis.llm.substring_dedup import dedup_substrings


def brute(texts, size):
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def check(spark, rows, size, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(parts)
    got = sorted(((str(r.doc_id), r.n_words, r.n_removed, r.kept_text, r.shard) for r in dedup_substrings(df, size).collect()), key=str)
    want = sorted(((str(r[0]), *b, r[2]) for r, b in zip(rows, brute([r[1] for r in rows], size))), key=str)
    assert got == want


def test_given_documents(spark, sf, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 100_000)
    rows = duckdb.sql(f"select doc_id, text, source from read_parquet('{sf}/documents.parquet')").fetchall()
    check(spark, rows, 35)


def test_edges(spark):
    rnd = random.Random(5)
    word = lambda: rnd.choice("abcdé") + str(rnd.randrange(30))
    passage = [word() for _ in range(40)]
    rows = [(1, None, "n"), (2, "", "n"), (3, "x y", None), (None, " ".join(passage), "a"), (None, " ".join(passage), "a"),
            (4, "  ".join(passage) + "\n" + " ".join(passage), "b"), (5, "z " * 300, "c"), (6, "q " * 10, "c")]
    rows += [(10 + i, " ".join([word() for _ in range(rnd.randrange(60))] + passage[5:35] + [word() for _ in range(50)]), "s") for i in range(30)]
    rows += [(100 + i, " ".join(word() for _ in range(200)), "s") for i in range(10)]
    check(spark, rows, 10)
    check(spark, rows, 1)
    assert dedup_substrings(spark.createDataFrame([], "doc_id long, text string"), 10).count() == 0


def test_query_digest(spark, sf):
    from lexis.llm.queries import QUERIES
    rows = duckdb.sql(f"select doc_id, text from read_parquet('{sf}/documents.parquet')").fetchall()
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for (d, _), (n, k, t) in zip(rows, brute([r[1] for r in rows], 35))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op9_substring_dedup"](spark, sf).collect()}
    assert got == want


def test_a_buffer_costs_the_same_at_any_number_of_shards(monkeypatch):
    import numpy as np
    from lexis.llm import substring_dedup as sd
    rng = np.random.default_rng(3)
    first = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    first[50:60] = first[40:50]
    for exact in (True, False):
        for shards in (11, 625, 40_000, 10_000_000):
            buffer = sd._Buffer(shards, exact)
            for row in range(8):
                at = slice(row * 50, row * 50 + 50)
                buffer.add(row * 7919, first[at], (first[at] >> np.uint64(5)).astype(np.uint32), np.arange(50))
            batches = list(buffer.flush())
            told = [b.column(0)[0].as_py() for b in batches]
            assert told == sorted(set(told)) and len(told) <= 398 + 8  # one per shard that occurs
            asked = sum(len(b.column(3)[0].as_py()) for b in batches) // (8 if exact else 4)
            known = sum(len(np.frombuffer(b.column("known_rids")[0].as_py(), np.int64)) for b in batches)
            assert asked == 380 and known == 2
