"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is the set of its distinct word shingles (A-Z lower-cased).  A document
contains it when at least ``percent`` % of the item's shingles occur in the
document.  MinHash compares sets of like size, so sizes are partitioned: items
fall into classes ``[2^c, 2^(c+1))`` of their number of shingles, and for every
class in use each whole document is cut into windows of ``2^(c+2)`` shingles that
overlap by half, so any passage as long as an item of the class lies in one
window whole.  Such a pair's similarity is at least 0.8 / 4.2 at ``percent`` 80,
and ``PLACES`` MinHash values miss it with probability 1.5e-6 at that bound.

A window's values are looked up in a Bloom filter of the items' values first;
only hits leave the scan, together with the document's shingles that a second
filter takes for item shingles.  Both filters have a fixed size, whatever the
number of items: more items only let more false hits through.  A shuffled join
with the items' values gives the candidates, and each is verified by exact
containment: all of the document's shingles that the item can have are there,
since a Bloom filter never misses.

Skew: a passage in many documents makes one small row per document; the joins
have one row per item on the other side and are split by adaptive execution.

Defined cases: an item with fewer words than a shingle, or null text, has no
shingle and is contained nowhere; rows with a null id take part, their pairs
carry the null; equal item texts are separate items; a document row that is
repeated gives its pairs once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.words import LOWER, U64, Words, chain, column, inside, mix, text_slices
from lexis.session import materialize

PLACES = 64
BITS = 24  # log2 of the bits of each Bloom filter: 2 MiB
PROBES = 3


def _minhash(hashes: np.ndarray, j: int) -> np.ndarray:
    times, flip = (int(x) for x in np.random.default_rng(977 + j).integers(0, 2**63, 2, dtype=np.uint64))
    return (hashes ^ U64(flip)) * U64((2 * times + 1) % (1 << 64))


def _name(value: np.ndarray, j: int, size_class: int) -> np.ndarray:
    return mix(value + U64((j * 64 + size_class + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


class Bloom:
    """Bloom filter of fixed size over 64-bit names."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(names: np.ndarray) -> list[np.ndarray]:
        names = mix(names)
        return [(names >> U64(20 * p)) & U64((1 << BITS) - 1) for p in range(PROBES - 1)] + [
            (mix(names ^ U64(0xB100)) >> U64(40)) & U64((1 << BITS) - 1)]

    def hits(self, names: np.ndarray) -> np.ndarray:
        out = np.ones(len(names), bool)
        for at in self.places(names):
            out &= (self.bits[at >> U64(3)] >> (at & U64(7)).astype(np.uint8)) & 1 > 0
        return out


def _bloom(names: DataFrame) -> Bloom:
    """Filter of ``names(name)``, filled from its distinct set bits: at most
    2^24, packed by a Spark aggregate into words of 64 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BITS - 3), np.uint8)
        for batch in batches:
            for at in Bloom.places(column(batch, "name").to_numpy().view(np.uint64)):
                np.bitwise_or.at(bits, at >> U64(3), np.uint8(1) << (at & U64(7)).astype(np.uint8))
        words = bits.view(np.int64)
        some = np.flatnonzero(words)
        yield pa.record_batch({"at": pa.array(some, pa.int32()), "word": pa.array(words[some])})

    found = names.mapInArrow(run, "at int, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return Bloom(words.view(np.uint8))


def _documents(words: Words, size: int) -> list[np.ndarray]:
    """Shingle hashes of each document of a slice, in order."""
    at, _ = inside(words.counts, size)
    runs = chain(words.hashes(0, LOWER), size)
    runs = runs[at] if len(at) else np.empty(0, np.uint64)
    return np.split(runs, np.cumsum(np.maximum(words.counts - size + 1, 0))[:-1])


def _items(size: int):
    """Item sets, their size class, and the names of their MinHash values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in text_slices(batch):
                sets = [np.unique(x) for x in _documents(words, size)]
                keep = [i for i, s in enumerate(sets) if len(s)]
                classes = [int(len(sets[i])).bit_length() - 1 for i in keep]
                names = [np.concatenate([_name(_minhash(sets[i], j).min(keepdims=True), j, c) for j in range(PLACES)]).view(np.int64)
                         for i, c in zip(keep, classes)]
                yield pa.record_batch({"item_id": column(batch, "item_id").slice(a, b - a).take(pa.array(keep, pa.int64())),
                                       "shingles": pa.array([sets[i].view(np.int64) for i in keep], pa.list_(pa.int64())),
                                       "size_class": pa.array(classes, pa.int32()),
                                       "names": pa.array(names, pa.list_(pa.int64()))})
    return run


def _hits(size: int, classes: list[int], by_name: Bloom, by_shingle: Bloom):
    """Per document with a hit: the hit names and the shingles items may have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, words in text_slices(batch):
                docs = _documents(words, size)
                ids, found, shingles = [], [], []
                near = [by_shingle.hits(d) for d in docs]
                for i, (hashes, close) in enumerate(zip(docs, near)):
                    if not close.any():
                        continue  # no shingle of any item: no window value can be an item's
                    names = _window_names(hashes, classes)
                    names = np.unique(names[by_name.hits(names)])
                    if len(names):
                        ids.append(a + i)
                        found.append(names.view(np.int64))
                        shingles.append(np.unique(hashes[close]).view(np.int64))
                yield pa.record_batch({"doc_id": column(batch, "doc_id").take(pa.array(ids, pa.int64())),
                                       "names": pa.array(found, pa.list_(pa.int64())), "shingles": pa.array(shingles, pa.list_(pa.int64()))})
    return run


def _window_names(hashes: np.ndarray, classes: list[int]) -> np.ndarray:
    """Names of the MinHash values of all windows of all size classes."""
    out = []
    for j in range(PLACES):
        values = _minhash(hashes, j)
        for c in classes:  # windows of two steps that overlap by one
            step = 1 << (c + 1)
            low = np.minimum.reduceat(values, np.arange(0, len(values), step))
            if len(low) > 1:
                low = np.minimum(low[:-1], low[1:])
            out.append(_name(low, j, c))
    return np.concatenate(out)


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared`` of every pair in which
    ``docs(doc_id, text)`` contains ``percent`` % of the shingles of
    ``items(item_id, text)``."""
    book = materialize(items.select("item_id", "text").mapInArrow(
        _items(shingle), "item_id long, shingles array<long>, size_class int, names array<long>")
        .withColumn("item", F.monotonically_increasing_id()), "benchmark")
    classes = sorted(r[0] for r in book.select("size_class").distinct().collect())  # at most 64
    by_name = _bloom(book.select(F.explode("names").alias("name")))
    by_shingle = _bloom(book.select(F.explode("shingles").alias("name")))
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast((by_name, by_shingle))  # 2 x 2 MiB

    def run(batches):
        yield from _hits(shingle, classes, *filters.value)(batches)

    hits = materialize(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, names array<long>, shingles array<long>")
                       .distinct().withColumn("hit", F.monotonically_increasing_id()), "benchmark-hits")
    pairs = (hits.select("hit", F.explode("names").alias("name"))
             .join(book.select("item", F.explode("names").alias("name")), "name").select("hit", "item").distinct())
    both = (pairs.join(hits.select("hit", "doc_id", F.col("shingles").alias("theirs")), "hit")
            .join(book.select("item", "item_id", F.col("shingles").alias("ours")), "item"))
    both = both.withColumn("n_item", F.size("ours").cast("long")).withColumn(
        "n_shared", F.size(F.array_intersect("ours", "theirs")).cast("long"))
    return both.filter(F.col("n_shared") * 100 >= F.col("n_item") * percent).select("doc_id", "item_id", "n_item", "n_shared")


def clean(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` that contain no item (rows with a null doc_id stay)."""
    found = contaminated(docs, items, shingle, percent).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
