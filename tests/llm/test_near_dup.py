"""Near duplicates against a brute-force comparison of all pairs."""

import itertools
import random

import duckdb

from lexis.llm import near_dup
from lexis.llm.near_dup import near_duplicates


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    seen = set()
    for members in by.values():
        for i, j in itertools.combinations(members, 2):
            if (i, j) not in seen:
                seen.add((i, j))
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    a, b = root(i), root(j)
                    up[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return {d: (len(sets[i]), low[root(i)], d == low[root(i)]) for i, (d, _) in enumerate(rows)}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_given_documents_match_brute_force(spark, sf):
    rows = duckdb.sql(f"select doc_id, text from read_parquet('{sf}/documents.parquet')").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, 3, 85)) == brute(rows, 3, 85)


def test_edge_cases_and_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    base = [rnd.choice(vocab) for _ in range(120)]
    rows = [(i, None if i == 3 else " \t" if i == 4 else "A b" if i in (5, 6) else "one" if i == 7 else "") for i in range(3, 9)]
    for i in range(10, 70):  # one large group, some members near the threshold
        copy = list(base)
        for _ in range(rnd.randint(0, 6)):
            copy[rnd.randrange(120)] = rnd.choice(vocab)
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(rnd.choice(vocab) for _ in range(60))) for i in range(20)]
    rows.append((200, " ".join(base * 50)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F
    df = df.withColumn("node", F.lit(1)).withColumn("cluster", F.lit("x")).repartition(5)
    assert result(near_duplicates(df, 3, 85)) == brute(rows, 3, 85)


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f g h"), (4, "a b c d e f g h"), (None, "x y z"), (-2, "x y z"), (9, "p q r"), (9, "p q r")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in got) == sorted(
        [("None", 4, False), ("4", 4, True), ("None", -2, False), ("-2", -2, True), ("9", 9, True), ("9", 9, True)])
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    from lexis.llm.graph import components
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1001 + i) for i in range(50)]
    cycle = [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    rnd = random.Random(0)
    rest = [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(70)] + [(5, 5), (-7, 3)]
    edges = chain + star + cycle + rest
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
