"""Centroid clustering by Walsh-Hadamard progressive search.

Components become integers ``floor(scale * c)``.  Their Walsh-Hadamard transform
(entries +1 and -1, coefficients by rising number of sign changes) keeps squared
distances up to the factor ``dims`` and is exact in integers, so the nearest
centroid is found in the transformed space: squared differences are added coarse
to fine; after the first coefficients the leading centroid's distance is finished
and from then on every centroid whose sum so far is strictly larger is out, as
its sum can only grow.  Those left finish all coefficients; of equal distances
the smaller number wins.

Vectors are transformed once and written; every round is one pass that adds up
counts and sums of coefficients per cluster and task.  Only ``k`` centroids reach
the driver.  The start centroids are the ``k`` vectors with the smallest sha256
of ``seed:id``.

Defined cases: vectors that are null, of another length than ``dims``, or hold a
null, non-finite or too large component (``|scale * c|`` of 2^27 or more, where
distances would outgrow a long) take no part; a null id counts as the empty text
in the hash; rows that repeat an id are clustered one by one, and of equal hashes
the smaller vector comes first; with fewer than ``k`` vectors there are as many
centroids; an empty centroid stays where it is; an inertia beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.words import column
from lexis.session import materialize

LIMIT = float(1 << 27)
COARSE = 4          # coefficients before the first elimination
SLICE = 1 << 14     # vectors searched at a time


def sequency(dims: int) -> np.ndarray:
    """Positions of the butterfly's coefficients by rising number of sign changes."""
    rows = butterfly(np.eye(dims, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def butterfly(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row, by sums and differences only."""
    n, dims = x.shape
    width = 1
    while width < dims:
        pairs = x.reshape(n, dims // (2 * width), 2, width)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, dims)
        width *= 2
    return x


def walsh(x: np.ndarray) -> np.ndarray:
    return butterfly(x)[:, sequency(x.shape[1])]


def unwalsh(coefficients: np.ndarray) -> np.ndarray:
    """``dims`` times the vectors behind the coefficients (exact integers)."""
    plain = np.empty_like(coefficients)
    plain[:, sequency(coefficients.shape[1])] = coefficients
    return butterfly(plain)


def search(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every row and its squared distance, both given by their
    coefficients; also the number of coefficient differences that were computed."""
    n, dims = rows.shape
    span = max(int(np.abs(rows).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if (2 * span) ** 2 * dims >= 1 << 62:  # coefficient sums could leave 64 bits: Python's integers
        rows, centroids = rows.astype(object), centroids.astype(object)
    kind = rows.dtype
    total, alive, work = np.zeros((n, len(centroids)), kind), np.ones((n, len(centroids)), bool), 0

    def add(j: int, who: np.ndarray, a: int, b: int) -> int:
        d = rows[who, a:b] - centroids[j, a:b]
        total[who, j] += (d * d).sum(axis=1)
        return len(who) * (b - a)

    first = min(COARSE, dims)
    every = np.arange(n)
    for j in range(len(centroids)):
        work += add(j, every, 0, first)
    lead = np.argmin(total, axis=1)
    for j in range(len(centroids)):
        work += add(j, np.flatnonzero(lead == j), first, dims)
    bound = total[every, lead]
    a = first
    while a < dims:
        alive &= total <= bound[:, None]
        b = min(2 * a, dims)
        for j in range(len(centroids)):
            work += add(j, np.flatnonzero(alive[:, j] & (lead != j)), a, b)
        a = b
    alive &= total <= bound[:, None]
    best = np.argmin(np.where(alive, total, total.max(initial=0) + 1), axis=1)  # the first of equal ones
    return best, total[every, best] // dims, work


def _coefficients(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    values = column(batch, "__h")
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), dims)


def transformed(vectors: DataFrame, id_col: str, vector_col: str, scale: float, dims: int) -> DataFrame:
    """``__id, __x, __h``: integer vectors that take part and their coefficients."""
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(vector_col).cast("array<double>").alias("__v"))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(LIMIT))
    rows = rows.filter((F.size("__v") == dims) & F.coalesce(F.forall("__v", fits), F.lit(False)))
    rows = rows.select("__id", F.transform("__v", lambda c: F.floor(c * F.lit(float(scale)))).alias("__x"))
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = column(batch, "__x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)
            h = walsh(x).ravel()
            packed = pa.ListArray.from_arrays(pa.array(np.arange(0, len(h) + 1, dims), pa.int32()), pa.array(h, pa.int64()))
            yield pa.record_batch([column(batch, "__id"), column(batch, "__x"), packed], names=["__id", "__x", "__h"])

    return rows.mapInArrow(run, f"__id {id_type}, __x array<long>, __h array<long>")


def starts(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of ``seed:id``, in hash order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit(""))), 256)
    return [list(r["__x"]) for r in rows.select(key.alias("__key"), "__x").orderBy("__key", "__x").limit(k).collect()]  # k rows


def means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of each cluster's exact mean."""
    k, dims = centroids.shape
    aims = walsh(centroids)

    def run(batches):
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for batch in batches:
            h = _coefficients(batch, dims)
            for a in range(0, len(h), SLICE):
                part = h[a:a + SLICE]
                best, _, _ = search(part, aims)
                for j in range(k):
                    mine = part[best == j]
                    if len(mine):
                        count[j] += len(mine)
                        total[j] = [t + int(v) for t, v in zip(total[j], mine.sum(axis=0))]
        held = [j for j in range(k) if count[j]]
        if held:
            values = [v for j in held for v in (*total[j], count[j])]
            yield pa.record_batch([pa.array(np.repeat(held, dims + 1), pa.int32()), pa.array(np.tile(np.arange(dims + 1), len(held)), pa.int32()),
                                   pa.array(values, pa.decimal128(38, 0))], names=["cluster", "at", "part"])

    parts = rows.select("__h").mapInArrow(run, "cluster int, at int, part decimal(38,0)")
    found = {(r["cluster"], r["at"]): int(r["s"]) for r in parts.groupBy("cluster", "at").agg(F.sum("part").alias("s")).collect()}  # k * (dims + 1)
    out = centroids.copy()
    for j in range(k):
        if (j, dims) in found:
            sums = unwalsh(np.array([[found[j, i] for i in range(dims)]], object))[0]
            out[j] = [int(s) // dims // found[j, dims] for s in sums]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``__id, cluster, distance`` of every vector."""
    dims, aims = centroids.shape[1], walsh(centroids)
    id_type = rows.schema["__id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            h, ids = _coefficients(batch, dims), column(batch, "__id")
            for a in range(0, len(h), SLICE):
                best, far, _ = search(h[a:a + SLICE], aims)
                yield pa.record_batch([ids.slice(a, len(best)), pa.array(best, pa.int32()), pa.array(far.astype(np.int64))],
                                      names=["__id", "cluster", "distance"])

    return rows.select("__id", "__h").mapInArrow(run, f"__id {id_type}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: float = 1024, seed: str = "3", dims: int = 64,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of
    every vector that takes part; ``dims`` is a power of two."""
    if dims < 1 or dims & (dims - 1):
        raise ValueError("dims must be a power of two")
    rows = materialize(transformed(vectors, id_col, vector_col, scale, dims), "walsh-vectors")
    first = starts(rows, k, seed)
    centroids = np.array(first, np.int64).reshape(-1, dims)
    for _ in range(rounds if len(first) else 0):
        after = means(rows, centroids)
        if (after == centroids).all():
            break  # further rounds change nothing
        centroids = after
    if not first:
        empty = vectors.limit(0).select(F.col(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty.select("*", *(F.lit(0).cast("long").alias(c) for c in ("cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    found = materialize(assigned(rows, centroids), "walsh-assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    by = {r["cluster"]: int(r["s"]) for r in sums}
    fit = lambda v: v if v < 1 << 63 else None
    every = fit(sum(by.values()))
    notes = [(j, fit(s), every, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, s in sorted(by.items())]
    book = vectors.sparkSession.createDataFrame(notes, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(book), "cluster").select(  # k rows
        F.col("__id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
