"""Containment search against a brute-force comparison of all pairs."""

import random

import duckdb
from pyspark.sql import functions as F

from lexis.llm.decontaminate import clean, contaminated


def grams(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items, percent=80):
    sets = [(d, grams(t)) for d, t in docs]
    return {(d, i, len(q), len(q & s)) for i, t in items if (q := grams(t)) for d, s in sets if 100 * len(q & s) >= percent * len(q)}


def test_given_tables(spark, sf):
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{sf}/documents.parquet')").fetchall()
    items = duckdb.sql(f"select item_id, text from read_parquet('{sf}/benchmark.parquet')").fetchall()
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == brute(docs, items)


def test_planted_items_and_edges(spark):
    rnd = random.Random(11)
    word = lambda: f"w{rnd.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rnd.choice([5, 6, 9, 20, 40, 80, 300])))) for i in range(60)]
    items += [(60, "too short"), (61, None), (62, ""), (63, items[3][1]), (64, "a a a a a a a a")]
    docs = [(i, " ".join(word() for _ in range(rnd.randrange(3000)))) for i in range(80)] + [(200, None), (201, ""), (202, "a " * 50)]
    for i in range(120):  # an item, some with edits, inside a long document
        text = rnd.choice(items[:60])[1].split()
        if rnd.random() < 0.4 and len(text) > 40:
            text[rnd.randrange(len(text))] = "edit"
        docs.append((300 + i, " ".join([word() for _ in range(rnd.randrange(2000))] + [x.upper() for x in text] + [word() for _ in range(500)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shingles", F.lit(1)).withColumn("item_id", F.lit("x"))
    want = brute(docs, items)
    book = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = {tuple(r) for r in contaminated(df.repartition(4), book).collect()}
    assert got == want and len(want) > 100
    dirty = {d for d, *_ in want}
    assert {r.doc_id for r in clean(df, book).collect()} == {d for d, _ in docs} - dirty
    none = spark.createDataFrame([], "doc_id long, text string")
    assert contaminated(none, book).count() == 0
    assert contaminated(df, none.withColumnRenamed("doc_id", "item_id")).count() == 0
