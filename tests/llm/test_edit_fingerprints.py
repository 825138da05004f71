"""Edit fingerprints against a step-by-step walk and a plain pass over sorted rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexis.llm import edit_fingerprints as ef
from lexis.llm.words import mix
from lexis.llm.queries import QUERIES
from lexis.llm.registry import table


def plain_fingerprint(text):
    """The definition: one output step after the other, then the last record of every slot."""
    import numpy as np
    codes = bytearray()
    for w in range(ef.WALKS):
        bits = np.random.default_rng(100 + w).integers(0, 2, (256, ef.PERIOD), dtype=np.uint8)
        bits[:, -1] = 1
        output, step = [], 0
        for i, char in enumerate(text):
            kind = (ord(char) * 0x9E3779B1 & 0xFFFFFFFF) >> 24
            while True:
                output.append(i)
                step += 1
                if bits[kind][(step - 1) % ef.PERIOD]:
                    break
        place, slot = ef._PLACES[w]
        for s in range(ef.SLOTS):
            at = max(int(p) for p, t in zip(place, slot) if t == s and p < len(output)) if output else 0
            if not output:
                continue
            code = at * int(ef.FACTORS[ef.CONTEXT])
            for k in range(ef.CONTEXT):
                j = output[at] - (ef.CONTEXT - 1) + k
                code += ((ord(text[j]) if j >= 0 else 0) + 1) * int(ef.FACTORS[k])
            codes.append(int(mix(np.array([code & (2 ** 64 - 1)], np.uint64))[0]) >> 56)
    return codes.hex() if text else ""


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        a, b, c = (ef.fingerprint(x) for x in (t, edited, following))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, ef.likeness(a, b), ef.likeness(a, c)))
    return out


@pytest.mark.parametrize("text", ["", "a", "ab", "naïve 🔥 text", "the same words " * 40])
def test_walk_equals_its_definition(text, monkeypatch):
    assert ef.fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(ef, "CHUNK", 7)
    assert ef.fingerprint(text) == plain_fingerprint(text)
    walk = ef.Walk().feed(text[:5])
    assert walk.fork().feed(text[5:]).fingerprint() == plain_fingerprint(text)


def test_few_edits_keep_most_of_the_fingerprint(spark, sf):
    random.seed(1)
    texts = [r.text for r in table(spark, sf, "documents").filter(F.length("text") > 1500).select("text").limit(40).collect()]
    near, far = [], []
    for a, b in zip(texts, texts[1:]):
        chars = list(a)
        for _ in range(3):
            at = random.randrange(len(chars))
            chars[at:at + random.randrange(2)] = random.choice("qxz")
        near.append(ef.likeness(ef.fingerprint(a), ef.fingerprint("".join(chars))))
        far.append(ef.likeness(ef.fingerprint(a), ef.fingerprint(b)) if a[:200] != b[:200] else 0.0)
    near.sort()
    assert near[len(near) // 2] > 0.9 and near[2] > 0.7 and max(far) < 0.3
    assert ef.likeness("", "") == 1.0 and ef.likeness("", ef.fingerprint("a")) == 0.0
    code = ef.fingerprint(texts[0])
    assert len(ef.bands(code)) == ef.WALKS * ef.SLOTS // ef.BAND and ef.likeness(code, code) == 1.0


def test_rows_equal_brute_force(spark):
    rows = [(i, f"document {i} " * (i % 7) + "tail") for i in range(60)]
    rows += [(200 + i, "one common text of a large group") for i in range(50)] + [(61, None), (62, ""), (None, "without an id"), (63, "x"),
                                                                                   (64, "long " * 20000), (65, "é🔥" * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("n_chars", F.lit("x")).withColumn("kind", F.lit(1))
    got = sorted(map(tuple, ef.fingerprint_with_next(df).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    assert len({r[3] for r in got if r[0] is not None and r[0] >= 200}) == 1


@pytest.mark.parametrize("rows", [[], [(5, "all alone here")], [(1, "a b"), (1, "a b"), (1, None)]])
def test_small_tables_and_repeated_rows(spark, rows):
    got = ef.fingerprint_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    if len(rows) == 1:
        assert tuple(got[0]) == brute(rows)[0] and got[0].near_next == 1.0


def test_query_over_the_given_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_document_fingerprints"](spark, sf).collect())) == sorted(brute(rows))


def test_string_ids(spark):
    got = ef.fingerprint_with_next(spark.createDataFrame([("b", "second"), ("a", "first one")], "doc_id string, text string")).collect()
    assert {r.doc_id: r.n_chars for r in got} == {"a": 9, "b": 6}
