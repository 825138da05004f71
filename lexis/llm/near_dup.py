"""Near-duplicate documents: b-bit MinHash signatures joined by a multi-index.

A document is the set of its distinct word shingles (A-Z lower-cased).  Its
signature is ``chunks * width`` MinHash values of 16 bits; the distance of two
signatures is the number of places in which they differ.  The signature is cut
into ``chunks`` chunks of ``width`` places.  By the pigeonhole principle two
signatures that differ in at most ``2 * chunks - 1`` places have a chunk with at
most one error, and all ways to have one error in a chunk are enumerated by
leaving out each of its places in turn: ``chunks * width`` index keys per
signature.  So every pair up to that distance meets in a bucket.  At the
defaults (8 chunks of 6) a pair at similarity 0.85 meets with probability
1 - 6e-6; ``LIMIT`` (20 of 48 places, beyond the guaranteed 15) only drops
bucket neighbours that are hopeless (similarity 0.85 exceeds it with
probability 5e-7).  Links are confirmed on the full shingle sets.

Cost and skew: equal sets are collapsed first by a partial aggregate, so copies
cost one row each.  Inside a bucket, and later inside a cluster of bucket
neighbours, a breadth-first search compares each member only with members not
yet reached, so a large group of near copies costs about one comparison each,
and only a spanning forest leaves the task, never all pairs.  Buckets and
clusters beyond ``BLOCK`` rows are cut into blocks and every pair of blocks is
a task of bounded size, which keeps the result exact.

Defined cases: null text, or a text without words, has ``n_shingles`` 0 and is
linked with nothing (its component is its own doc_id); a row with null doc_id
takes part, its component is the smallest known doc_id it reaches, else null,
and it is never ``kept``; rows that repeat a doc_id and its text are all kept or
none (they share id and component); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.graph import components
from lexis.llm.words import LOWER, U64, Words, chain, column, inside, mix, text_slices
from lexis.session import materialize

CHUNKS, WIDTH = 8, 6
LIMIT = 20
BLOCK = 512


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of the slice; a document
    with fewer words than ``size`` is one shingle of all its words."""
    counts = words.counts
    if not len(words):
        return [np.empty(0, np.uint64)] * len(counts)
    hashes = words.hashes(0, LOWER)
    at, _ = inside(counts, size)
    runs = chain(hashes, size)
    runs = runs[at] if len(at) else np.empty(0, np.uint64)
    ends = np.cumsum(np.maximum(counts - size + 1, 0))
    out = []
    for d, n in enumerate(counts):
        if n >= size:
            out.append(np.unique(runs[ends[d] - (n - size + 1):ends[d]]))
        elif n:
            out.append(chain(hashes[words.first[d]:words.first[d + 1]], int(n)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """16-bit MinHash values, one row per non-empty set."""
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    begin = np.cumsum([0] + [len(s) for s in sets])[:-1]
    rng = np.random.default_rng(2014)
    out = np.empty((len(sets), places), dtype=np.uint16)
    for j in range(places):
        times, flip = (int(x) for x in rng.integers(0, 2**63, 2, dtype=np.uint64))
        if len(flat):
            out[:, j] = mix(np.minimum.reduceat((flat ^ U64(flip)) * U64((2 * times + 1) % (1 << 64)), begin)) & U64(0xFFFF)
    return out


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _sketch(size: int, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in text_slices(batch):
                sets = shingle_sets(words, size)
                full = [s for s in sets if len(s)]
                sigs = iter(signatures(full, places))
                yield pa.record_batch({
                    "doc_id": column(batch, "doc_id").slice(a, b - a),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "f1": _longs([mix(s).sum(dtype=np.uint64) for s in sets]),
                    "f2": _longs([mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets]),
                    "sig": pa.array([next(sigs).tobytes() if len(s) else None for s in sets], pa.binary())})
    return run


def _index_keys(chunks: int, width: int):
    """One row per signature and way to leave one place out of one chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _matrix(column(batch, "sig")).astype(np.uint64)
            for c in range(chunks):
                for gap in range(width):
                    key = np.full(len(sig), c * width + gap, dtype=np.uint64)
                    for place in range(c * width, (c + 1) * width):
                        if place != c * width + gap:
                            key = mix(key * U64(0x9E3779B97F4A7C15) + sig[:, place])
                    yield pa.record_batch({"key": _longs(key), "node": column(batch, "node")})
    return run


def _matrix(sigs: pa.Array) -> np.ndarray:
    rows = sigs.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.uint16).reshape(len(rows), -1)


def _stars(ids: np.ndarray, near) -> Iterator[tuple[int, int]]:
    """Connected components of a graph on ``range(len(ids))`` by breadth-first
    search, each as edges to its smallest id; ``near(i, rest)`` tells which
    members of ``rest`` neighbour ``i``."""
    rest = np.arange(len(ids))
    while len(rest):
        found, rest, at = [int(rest[0])], rest[1:], 0
        while at < len(found) and len(rest):
            hit = near(found[at], rest)
            found.extend(rest[hit].tolist())
            rest, at = rest[~hit], at + 1
        names = ids[found]
        low = int(names.min())
        yield from ((low, int(x)) for x in names if x != low)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by ``keys`` (bounded groups)."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        mark = np.stack([held.column(k).to_numpy() for k in keys])
        cut = np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1
        if len(cut):
            yield held.slice(0, int(cut[-1]))
            held = held.slice(int(cut[-1]))
    if held is not None and held.num_rows:
        yield held


def _groups(table: pa.Table, keys: list[str]) -> Iterator[tuple[int, int]]:
    mark = np.stack([table.column(k).to_numpy() for k in keys])
    cut = [0, *(np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1).tolist(), table.num_rows]
    yield from zip(cut, cut[1:])


def _similar_size(mine: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(sizes, mine) >= percent * np.maximum(sizes, mine)


def _bucket_edges(percent: int, limit: int):
    """Spanning edges among bucket members with close signatures."""
    keys = ["key", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            sig = _matrix(table.column("sig"))
            a, b = [], []
            for lo, hi in _groups(table, keys):
                if hi - lo < 2:
                    continue
                s, m, ids = sig[lo:hi], n[lo:hi], node[lo:hi]

                def near(i, rest):
                    ok = _similar_size(m[i], m[rest], percent)
                    ok[ok] = (s[rest[ok]] != s[i]).sum(axis=1) <= limit
                    return ok

                for x, y in _stars(ids, near):
                    a.append(x)
                    b.append(y)
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _confirm(size: int, percent: int, limit: int, places: int):
    """Spanning edges of the graph of confirmed links inside each block unit."""
    keys = ["cluster", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            node = table.column("node").to_numpy()
            a, b = [], []
            for lo, hi in _groups(table, keys):
                part = table.slice(lo, hi - lo).combine_chunks()
                if part.num_rows < 2:
                    continue
                sets = [s for x in part.to_batches() for _, _, w in text_slices(x) for s in shingle_sets(w, size)]
                sig, n, ids = signatures(sets, places), np.array([len(s) for s in sets]), node[lo:hi]

                def near(i, rest):
                    ok = _similar_size(n[i], n[rest], percent)
                    ok[ok] = (sig[rest[ok]] != sig[i]).sum(axis=1) <= limit
                    some = np.flatnonzero(ok)
                    if len(some):
                        mine, others = sets[i], [sets[r] for r in rest[some]]
                        flat = np.concatenate(others)
                        spot = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                        sizes = n[rest[some]]
                        both = np.add.reduceat((mine[spot] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
                        ok[some] = 100 * both >= percent * (n[i] + sizes - both)
                    return ok

                for x, y in _stars(ids, near):
                    a.append(x)
                    b.append(y)
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _blocks(members: DataFrame, key: str) -> DataFrame:
    """Adds ``x <= y``: rows of a group are dealt to ``ceil(size / BLOCK)`` blocks
    and copied to every unit (pair of blocks) that holds their block."""
    sizes = members.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb")).filter("nb > 1")
    own = F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")
    return (members.join(sizes, key, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
            .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
            .drop("nb", "own", "other"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, chunks: int = CHUNKS,
                    width: int = WIDTH, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs(doc_id, text)``:
    documents are linked when ``100 * |A & B| >= percent * |A | B|``;
    ``component_id`` is the smallest doc_id reachable, ``kept`` marks its row
    (one row of each component when doc_ids are unique)."""
    places = chunks * width
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    fold = spark.conf.get("spark.sql.shuffle.partitions")
    sketch = materialize(docs.mapInArrow(
        _sketch(shingle, places), "doc_id long, n_shingles long, f1 long, f2 long, sig binary"), "sketch")
    # a node is a distinct set, named by its smallest doc_id (rows without one
    # get a negative name from their set)
    unnamed = -F.pmod(F.xxhash64("f1", "f2"), F.lit(1 << 62)) - 1
    nodes = materialize(sketch.filter("n_shingles > 0").groupBy("f1", "f2", F.col("n_shingles").alias("n"))
                        .agg(F.min("doc_id").alias("low"), F.first("sig").alias("sig"))
                        .withColumn("node", F.coalesce("low", unnamed)).drop("low"), "nodes")
    keys = nodes.select("node", "sig").mapInArrow(_index_keys(chunks, width), "key long, node long")
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    buckets = keys.join(shared, "key").join(nodes.select("node", "n", "sig"), "node")
    units = _blocks(buckets, "key").repartition(int(fold), "key", "x", "y").sortWithinPartitions("key", "x", "y")
    close = units.mapInArrow(_bucket_edges(percent, limit), "a long, b long").distinct()
    clusters = materialize(components(close, "close").withColumnRenamed("label", "cluster"), "clusters")
    # texts of clustered nodes only; the join is on the row that named the node
    named = docs.filter("doc_id is not null").select(F.col("doc_id").alias("node"), "text")
    wanted = clusters.filter("node >= 0")
    loose = clusters.filter("node < 0")
    texts = named.join(wanted.hint("merge"), "node")
    if docs.filter("doc_id is null or doc_id < 0").limit(1).count():
        # rows whose name is not their doc_id: name them again from their text
        again = docs.filter("doc_id is null or doc_id < 0").mapInArrow(
            _with_name(shingle), "doc_id long, f1 long, f2 long, text string")
        texts = texts.unionByName(again.withColumn("node", F.coalesce("doc_id", unnamed))
                                  .select("node", "text").join(loose, "node"))
    units = _blocks(texts, "cluster").repartition(int(fold), "cluster", "x", "y").sortWithinPartitions("cluster", "x", "y")
    links = units.mapInArrow(_confirm(shingle, percent, limit, places), "a long, b long").distinct()
    labels = components(links, "links")
    member = nodes.select("f1", "f2", F.col("n").alias("n_shingles"), "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")).drop("node")
    rows = sketch.drop("sig").join(member, ["f1", "f2", "n_shingles"], "left")
    rows = materialize(rows.select("doc_id", "n_shingles", "label"), "labelled")
    lowest = rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(lowest, "label", "left")
    found = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"),
                      F.coalesce(F.col("doc_id") == found, F.lit(False)).alias("kept"))


def _with_name(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in text_slices(batch):
                sets = shingle_sets(words, size)
                yield pa.record_batch({
                    "doc_id": column(batch, "doc_id").slice(a, b - a),
                    "f1": _longs([mix(s).sum(dtype=np.uint64) for s in sets]),
                    "f2": _longs([mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets]),
                    "text": column(batch, "text").slice(a, b - a)})
    return run
