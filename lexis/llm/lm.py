"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Tokens are words (A-Z lower-cased) and one end token per text.  Counting is two
shuffles of packed count arrays: tasks count their tokens in buffers and ship
distinct entries only, so a very frequent word or pair costs one entry per
buffer.  Each shard adds up its entries and saves sorted hash arrays (key, and
count or discounted statistics) in the shared folder; scoring tasks map those
files (``lexis.llm.blobs``) and look whole slices of tokens up by binary search,
so memory does not grow with the model.  Shards are ranges of the hash and their
number grows with the corpus; a word that makes up a thousandth of all tokens or
more (at most 1,000 words) has its followers spread over all shards.

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) * p1(w)
    p1(w)    = max(n(.w) - D1(n(.w)), 0) / n(..) + g1 / (V + 1)

with D by Chen and Goodman's three discounts (from counts of counts of each
level) and g the mass the discounts free; ``V + 1`` adds one unknown token.  An
unseen context uses p1 alone.  The order is 2: the distinct trigrams of the
corpus would not fit the disk budget stated in the README.

Words are told apart by 64 bits in unigram counts, by 40 bits of that hash
inside pairs.  Defined cases: null or empty text is the end token alone; an
untrained model (no training rows) gives every token p = 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.blobs import load, save
from lexis.llm.words import LOWER, U64, Words, column, mix, text_slices
from lexis.session import materialize, shared_path

BUFFER = 500_000
BYTES_PER_SHARD = 24_000_000
END, BEGIN = U64(0x0E0D_0E0D_0E0D_0E0D), U64(0xBE61_BE61_BE61_BE61)
SHORT = U64(24)  # the upper 40 bits name a word inside a pair
_PACK = "shard int, words binary, counts binary"
_PAIRS = "shard int, context binary, fans binary, follower binary, counts binary"


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of a slice with an end token per document, the token before
    each, and the number of tokens of each document."""
    sizes = words.counts + 1
    ends = np.cumsum(sizes) - 1
    flow = np.empty(len(words) + len(sizes), np.uint64)
    is_end = np.zeros(len(flow), bool)
    is_end[ends] = True
    flow[~is_end], flow[is_end] = words.hashes(0, LOWER), END
    before = np.empty_like(flow)
    before[1:] = flow[:-1]
    before[ends - words.counts] = BEGIN
    return flow, before, sizes


def _range(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of 64-bit hashes by range, so sorted keys are grouped by shard."""
    return (((keys >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int32)


def pair_key(context: np.ndarray, follower: np.ndarray) -> np.ndarray:
    return mix(context * U64(0x9E3779B97F4A7C15) + mix(follower))


def _pair_shard(context, follower, shards: int, hot: np.ndarray) -> np.ndarray:
    """Pairs live with their context, followers of hot contexts everywhere."""
    own = _range(context << SHORT, shards)
    return np.where(np.isin(context, hot), _range(mix(follower), shards), own) if len(hot) else own


def _five(x: np.ndarray) -> bytes:
    """40-bit values in five bytes each (a plane of four and a plane of one)."""
    return (x & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (x >> U64(32)).astype(np.uint8).tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    n = len(raw) // 5
    low, high = np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.uint8, n, 4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << U64(32))


def _small(counts: np.ndarray) -> bytes:
    """Counts as one byte each, larger ones as 255 and eight bytes at the end."""
    big = counts >= 255
    return np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype(np.int64).tobytes()


def _from_small(raw: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:], np.int64)
    return out


def _buffers(batches, column_name: str = "text"):
    held, size = [], 0
    for batch in batches:
        for _, _, words in text_slices(batch, column_name):
            flow, before, _ = tokens(words)
            held.append((flow, before))
            size += len(flow)
            if size >= BUFFER:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _split(shard: np.ndarray, shards: int):
    """Each shard that occurs, ascending, with its positions; the cost does not depend on ``shards``."""
    order = np.argsort(shard, kind="stable")
    told = shard[order]
    cuts = np.flatnonzero(np.append(True, told[1:] != told[:-1])) if len(told) else np.empty(0, np.int64)
    for a, b in zip(cuts, np.append(cuts[1:], len(told))):
        yield int(told[a]), order[a:b]


def _batch(schema: str, **values) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]
    return pa.record_batch([pa.array([values[n]], k) for n, k in zip(names, kinds)], names=names)


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flow, _ in _buffers(batches):
            word, count = np.unique(flow, return_counts=True)
            for s, at in _split(_range(word, shards), shards):
                yield _batch(_PACK, shard=s, words=word[at].tobytes(), counts=_small(count[at]))
    return run


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct words of a shard and their summed counts."""
    words = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
    counts = np.concatenate([_from_small(x, len(w)) for x, w in zip(table.column("counts").to_pylist(), words)])
    word, at = np.unique(np.concatenate(words), return_inverse=True)
    return word, np.bincount(at, weights=counts).astype(np.int64)


def _save_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        word, count = _added(table)
        save(folder, f"word-{shard}", word)
        save(folder, f"count-{shard}", count)
        often = count * 1000 >= count.sum()
        pairs = [{"w": w, "c": c} for w, c in zip(word[often].view(np.int64).tolist(), count[often].tolist())]
        return pa.table({"types": pa.array([len(word)], pa.int64()), "tokens": pa.array([int(count.sum())], pa.int64()),
                         "often": pa.array([pairs], pa.list_(pa.struct([("w", pa.int64()), ("c", pa.int64())])))})
    return run


def _count_pairs(shards: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flow, before in _buffers(batches):
            context, follower = before >> SHORT, flow >> SHORT
            order = np.lexsort((follower, context))
            context, follower = context[order], follower[order]
            new = np.append(True, (context[1:] != context[:-1]) | (follower[1:] != follower[:-1]))
            count = np.diff(np.append(np.flatnonzero(new), len(new)))
            context, follower = context[new], follower[new]
            for s, at in _split(_pair_shard(context, follower, shards, hot), shards):
                v = context[at]
                first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
                yield _batch(_PAIRS, shard=s, context=_five(v[first]), fans=_small(np.diff(np.append(first, len(v)))),
                             follower=_five(follower[at]), counts=_small(count[at]))
    return run


def _kinds(counts: np.ndarray, groups: np.ndarray, size: int) -> np.ndarray:
    """How many entries of each group have count 1, 2, and 3 or more."""
    return np.stack([np.bincount(groups[hit], minlength=size) for hit in
                     (counts == 1, counts == 2, counts > 2)], axis=1).astype(np.int64)


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


_PAIR_STATS = "shard int, words binary, counts binary, n array<long>, hot array<struct<v:long,k1:long,k2:long,k3:long>>"
_STAT_ARROW = pa.schema([("shard", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("n", pa.list_(pa.int64())),
                         ("hot", pa.list_(pa.struct([("v", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("k3", pa.int64())])))])


def _save_pairs(folder: str, shards: int, hot: np.ndarray):
    """Adds up a shard's pairs; saves them and its contexts; returns how many
    contexts each follower has here (packed per word shard) and counts of counts."""
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        contexts, followers, counts = [], [], []
        for row in table.select(["context", "fans", "follower", "counts"]).to_pylist():
            v, w = _from_five(row["context"]), _from_five(row["follower"])
            contexts.append(np.repeat(v, _from_small(row["fans"], len(v))))
            followers.append(w)
            counts.append(_from_small(row["counts"], len(w)))
        context, follower, count = np.concatenate(contexts), np.concatenate(followers), np.concatenate(counts)
        del contexts, followers, counts
        key = pair_key(context, follower)
        key, first, at = np.unique(key, return_index=True, return_inverse=True)
        count = np.bincount(at, weights=count).astype(np.int64)
        context, follower = context[first], follower[first]
        save(folder, f"pair-{shard}", key)
        save(folder, f"pairs-{shard}", count)
        name, group = np.unique(context, return_inverse=True)
        kinds = _kinds(count, group, len(name))
        often = np.isin(name, hot)
        save(folder, f"context-{shard}", name[~often])
        save(folder, f"kinds-{shard}", kinds[~often])
        word, contexts_of = np.unique(follower, return_counts=True)
        home = _range(word << SHORT, shards)
        rows = [{"shard": s, "words": word[x].tobytes(), "counts": _small(contexts_of[x]), "n": None, "hot": None}
                for s, x in _split(home, shards)]
        rows.append({"shard": -1, "words": None, "counts": None, "n": _of_counts(count), "hot": [
            {"v": v, "k1": a, "k2": b, "k3": c} for v, (a, b, c) in zip(name[often].view(np.int64).tolist(), kinds[often].tolist())]})
        return pa.Table.from_pylist(rows, schema=_STAT_ARROW)
    return run


def _save_fans(folder: str):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        word, fans = _added(table)
        save(folder, f"fan-{shard}", word)
        save(folder, f"fans-{shard}", fans)
        return pa.table({"n": [_of_counts(fans)], "pairs": pa.array([int(fans.sum())], pa.int64()), "k": [
            [int((fans == 1).sum()), int((fans == 2).sum()), int((fans > 2).sum())]]})
    return run


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3+; where the counts of
    counts are too few to estimate one, absolute discounting by one half."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


class Model:
    """What scoring needs beside the files: a few numbers and the hot contexts."""

    def __init__(self, folder, shards, types, total, pair_n, fan_n, fan_k, pairs, hot):
        self.folder, self.shards, self.types, self.total = folder, shards, types, total
        self.pairs, self.hot = pairs, hot
        self.pair_d, self.fan_d = np.array([0.0, *discounts(pair_n)]), np.array([0.0, *discounts(fan_n)])
        self.free = float(np.dot(fan_k, self.fan_d[1:])) / max(pairs, 1)


def train(docs: DataFrame) -> Model:
    """Counts ``docs(text)`` and saves the model's arrays in the shared folder."""
    spark = docs.sparkSession
    docs = docs.select("text")
    folder = shared_path(spark, "kneser-ney")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(size // BYTES_PER_SHARD) + 1
    often = "array<struct<w:long,c:long>>"
    found = materialize(docs.mapInArrow(_count_words(shards), _PACK).groupBy("shard").applyInArrow(
        _save_words(folder), f"types long, tokens long, often {often}"), "kn-words")
    types, total = (int(x or 0) for x in found.agg(F.sum("types"), F.sum("tokens")).first())
    limit = found.select(F.explode("often").alias("x")).filter(F.col("x.c") * 1000 >= total)
    names = [r[0] for r in limit.select("x.w").collect()]  # at most 1,000 by definition
    hot = np.unique(np.append(np.array(names, np.int64).view(np.uint64), BEGIN) >> SHORT)
    stats = materialize(docs.mapInArrow(_count_pairs(shards, hot), _PAIRS).groupBy("shard").applyInArrow(
        _save_pairs(folder, shards, hot), _PAIR_STATS), "kn-pairs")
    fans = materialize(stats.filter("shard >= 0").select("shard", "words", "counts").groupBy("shard").applyInArrow(
        _save_fans(folder), "n array<long>, pairs long, k array<long>"), "kn-fans")

    def sums(df, name, k):
        return [int(x or 0) for x in df.agg(*[F.sum(F.col(name)[i]) for i in range(k)]).first()]

    heads = (stats.filter("shard < 0").select(F.explode("hot").alias("h"))
             .groupBy("h.v").agg(F.sum("h.k1"), F.sum("h.k2"), F.sum("h.k3")).collect())  # at most 1,001
    pairs = int(fans.agg(F.sum("pairs")).first()[0] or 0)
    return Model(folder, shards, types, total, sums(stats, "n", 4), sums(fans, "n", 4), sums(fans, "k", 3), pairs,
                 {"v": np.array([h[0] for h in heads], np.int64).view(np.uint64) if heads else np.empty(0, np.uint64),
                  "k": np.array([h[1:] for h in heads], np.int64).reshape(-1, 3)})


@lru_cache(maxsize=4096)
def _file(folder: str, name: str, kind: str) -> np.ndarray:
    return load(folder, name, np.dtype(kind))


def _find(folder: str, keys: str, values: str, needle: np.ndarray, shard: np.ndarray, shards: int, wide: int = 1) -> np.ndarray:
    """Values of needles (0 where absent) from sorted arrays of their shards."""
    out = np.zeros((len(needle), wide) if wide > 1 else len(needle), np.int64)
    for s, at in _split(shard, shards):
        known = _file(folder, f"{keys}-{s}", "uint64")
        if len(known):
            spot = np.minimum(np.searchsorted(known, needle[at]), len(known) - 1)
            hit = known[spot] == needle[at]
            stored = _file(folder, f"{values}-{s}", "int64")
            out[at[hit]] = (stored.reshape(-1, wide) if wide > 1 else stored)[spot[hit]]
    return out


def _less(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.maximum(counts - d[np.minimum(counts, 3)], 0.0)


def token_scores(model: Model, flow: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 model probability and training count of every token."""
    folder, shards = model.folder, model.shards
    if not model.total:
        return np.zeros(len(flow)), np.zeros(len(flow), np.int64)
    word, at = np.unique(flow, return_inverse=True)
    seen = _find(folder, "word", "count", word, _range(word, shards), shards)
    short = word >> SHORT
    fans = _find(folder, "fan", "fans", short, _range(short << SHORT, shards), shards)
    base = _less(fans, model.fan_d) / max(model.pairs, 1) + model.free / (model.types + 1)
    ahead, back = np.unique(before, return_inverse=True)
    total = _find(folder, "word", "count", ahead, _range(ahead, shards), shards)
    total[ahead == BEGIN] = _find(folder, "word", "count", np.array([END]), _range(np.array([END]), shards), shards)[0]
    brief = ahead >> SHORT
    kinds = _find(folder, "context", "kinds", brief, _range(brief << SHORT, shards), shards, 3)
    if len(model.hot["v"]):
        order = np.argsort(model.hot["v"])
        spot = np.minimum(np.searchsorted(model.hot["v"][order], brief), len(order) - 1)
        hit = model.hot["v"][order][spot] == brief
        kinds[hit] = model.hot["k"][order][spot[hit]]
    # a pair of this slice is named by the ranks of its words: unique without hashing
    pair, where = np.unique(back.astype(np.int64) * len(word) + at, return_inverse=True)
    v, w = brief[pair // len(word)], short[pair % len(word)]
    key = pair_key(v, w)
    shard = _pair_shard(v, w, shards, model.hot["v"])
    order = np.argsort(key)
    both = np.zeros(len(key), np.int64)
    both[order] = _find(folder, "pair", "pairs", key[order], shard[order], shards)
    times = total[pair // len(word)]
    free = (kinds[pair // len(word)] * model.pair_d[1:]).sum(axis=1)
    p1 = base[pair % len(word)]
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(times > 0, (_less(both, model.pair_d) + free * p1) / times, p1)
    return np.log10(p)[where], seen[at]


def _score(model: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in text_slices(batch):
                flow, before, sizes = tokens(words)
                score, seen = token_scores(model, flow, before)
                begin = np.cumsum(sizes) - sizes
                flat = np.log10((seen + 0.1) / (model.total + 0.1 * (model.types + 1)))
                yield pa.record_batch({**{n: column(batch, n).slice(a, b - a) for n in names},
                                       "n_tokens": pa.array(sizes, pa.int64()),
                                       "n_known": pa.array(np.add.reduceat((seen > 0).astype(np.int64), begin)),
                                       "base_score": pa.array(np.add.reduceat(flat, begin)),
                                       "score": pa.array(np.add.reduceat(score, begin))})
    return run


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs(text, ...)`` with ``n_tokens, n_known,
    base_score, score`` (log10) and ``perplexity`` per row."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    schema += ", n_tokens long, n_known long, base_score double, score double"
    return docs.select("text", *[c for c in keep if c != "text"]).mapInArrow(_score(model, keep), schema).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
