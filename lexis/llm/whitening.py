"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers ``x = floor(scale * c) + offset``; the model is fitted on
the distinct x vectors.  They are written once, packed into blocks of rows; from
then on a block of ``components + GUARD`` directions Q is improved by passes that
each compute the centred product ``V Q = sum (x - m) (x - m)^T Q / n`` over all
blocks, one partial matrix per task, added up in Spark.  A round runs the
Chebyshev recurrence of ``DEGREE`` passes, which damps the spectrum below the
smallest Ritz value held, then QR and Rayleigh-Ritz.  It ends when the residual
``|V q - e q|`` of every wanted pair has reached rounding (``TIGHT`` of the
largest eigenvalue, or no longer falls), and when fresh random directions,
filtered outside the found ones, hold no larger eigenvalue.  Where the block
spans all dimensions the first Rayleigh-Ritz step is exact.

The driver holds sums, directions and products, whose size follows the dimension
and not the number of rows.  Centred entries come from the exact integers
``n x - S``.

Defined cases: rows whose vector is null or empty or holds a null, non-finite or
too large entry (``|scale * c|`` of 2^53 or more) are dropped, as are vectors of
another length than the commonest (of equally common ones the shorter); rows
without an id or with a repeated one are whitened one by one; directions whose
eigenvalue is below 1e-11 of the largest do not count as components, so equal
vectors, a single one or none give no row; a deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.words import column
from lexis.session import materialize

BLOCK_BYTES = 1 << 20
GUARD, DEGREE, ROUNDS = 16, 10, 40
TIGHT, RANK = 2e-15, 1e-11
PROBES = 4


def _finite(vector: Column, scale: float) -> Column:
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(float(1 << 53)))
    return F.coalesce(F.forall(vector, fits), F.lit(False)) & (F.size(vector) > 0)


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """``__id, __x``: integer vectors of the rows that take part, of any length."""
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(vector_col).cast("array<double>").alias("__v"))
    return rows.filter(_finite(F.col("__v"), scale)).select(
        "__id", F.transform("__v", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset).cast("long")).alias("__x"))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = column(batch, name)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = np.ascontiguousarray(_matrix(batch, "__x"))
            step = max(1, BLOCK_BYTES // x[0].nbytes)
            parts = [x[a:a + step] for a in range(0, len(x), step)]
            yield pa.record_batch([pa.array([p.tobytes() for p in parts], pa.binary())], names=["block"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in column(batch, "block"):
            yield np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim)


def _sums(blocks: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of packed vectors and their exact sum per dimension."""
    def run(batches):
        n, total = 0, [0] * dim
        for x in _blocks(batches, dim):
            # halves of 32 bits, so that no column sum of a block overflows
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low)]
            n += len(x)
        if n:
            yield pa.record_batch([pa.array(range(dim + 1), pa.int32()), pa.array([*total, n], pa.decimal128(38, 0))], names=["at", "part"])

    parts = blocks.mapInArrow(run, "at int, part decimal(38,0)")
    found = {r["at"]: int(r["s"]) for r in parts.groupBy("at").agg(F.sum("part").alias("s")).collect()}  # dim + 1 rows
    return found.get(dim, 0), [found.get(i, 0) for i in range(dim)]


class Centre:
    """Exact ``n x - S`` and the centred entries made from it."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S`` as 64-bit integers, or as Python's where those could overflow."""
        most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        if self.n * most + max(map(abs, self.sums)) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def squares(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of ``(n x - S)^2`` of each row, exact."""
        d = self.deviations(x)
        most = max(abs(int(d.min())), abs(int(d.max()))) if d.size else 0
        if d.dtype == object or most * most * d.shape[1] >= 1 << 62:
            d = d.astype(object)
        return [int(v) for v in (d * d).sum(axis=1)]


def _added(blocks: DataFrame, dim: int, size: int, part) -> np.ndarray:
    """Sum over all blocks of ``part(block)``, an array of ``size`` doubles."""
    def run(batches):
        total = None
        for x in _blocks(batches, dim):
            one = part(x)
            total = one if total is None else total + one
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(size), pa.int32()), pa.array(total, pa.float64())], names=["at", "part"])

    rows = blocks.mapInArrow(run, "at int, part double").groupBy("at").agg(F.sum("part").alias("s")).toArrow()  # size rows
    out = np.zeros(size)
    out[rows.column("at").to_numpy()] = rows.column("s").to_numpy()
    return out


def _product(blocks: DataFrame, centre: Centre, q: np.ndarray) -> np.ndarray:
    """``V q`` by one pass over the blocks."""
    dim, width = q.shape

    def part(x):
        c = centre.centred(x)
        return (c.T @ (c @ q)).ravel()
    return _added(blocks, dim, dim * width, part).reshape(dim, width) / centre.n


def _filtered(product, y: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of V times y: at most of size one on
    ``[0, cut]``, one at ``top``, so the spectrum up to ``cut`` is damped."""
    half = cut / 2
    sigma = first = half / (top - half)
    before, y = y, (product(y) - half * y) * (sigma / half)
    for _ in range(degree - 1):
        after = 1.0 / (2.0 / first - sigma)
        before, y = y, (product(y) - half * y) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return y


@dataclass
class Whitening:
    """Fitted model: vectors' length, distinct vectors, their sums, components by
    falling eigenvalue (as columns), eigenvalues, trace, identity error and the
    passes over the data that it took."""

    dim: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int


def subspace(product, dim: int, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and unit eigenvectors of the
    symmetric non-negative matrix behind ``product``."""
    rng = np.random.default_rng(seed)
    width, wanted = min(dim, wanted + GUARD), min(dim, wanted)
    q = np.linalg.qr(rng.normal(size=(dim, width)))[0]
    worst = np.inf
    for _ in range(ROUNDS):
        vq = product(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        if top <= 0:
            break
        wide = np.linalg.norm(vq - q * values, axis=0)[:wanted].max()
        settled = wide <= TIGHT * top or (wide <= 1e-12 * top and wide > 0.5 * worst)
        worst = min(worst, wide)
        if width == dim:
            break
        cut = max(values[-1], 1e-9 * top)
        if settled:
            probe = rng.normal(size=(dim, PROBES))
            probe -= q @ (q.T @ probe)
            edge = min(max(values[wanted - 1], cut), 0.999 * top)
            probe = _filtered(product, probe, edge, top, DEGREE)
            probe -= q @ (q.T @ probe)
            probe = np.linalg.qr(probe)[0]
            if np.linalg.eigvalsh(probe.T @ product(probe))[-1] <= values[wanted - 1] * (1 + 1e-9):
                break
            q = np.linalg.qr(np.concatenate([q[:, :width - PROBES], probe], axis=1))[0]
            worst = np.inf
            continue
        q = np.linalg.qr(_filtered(product, q, min(cut, 0.999 * top), top, DEGREE))[0]
    return values[:wanted], q[:, :wanted]


def fit(quantised: DataFrame, components: int = 16) -> Whitening | None:
    """Model of the distinct vectors of ``quantised(__x)``; None without any."""
    sizes = quantised.groupBy(F.size("__x").alias("dim")).count()
    common = sizes.orderBy(F.desc("count"), "dim").first()
    if common is None:
        return None
    dim = common["dim"]
    distinct = quantised.filter(F.size("__x") == dim).select("__x").distinct()
    blocks = materialize(distinct.mapInArrow(_pack, "block binary"), "whitening-blocks")
    n, sums = _sums(blocks, dim)
    centre, passes = Centre(n, sums), [0]

    def product(q):
        passes[0] += 1
        return _product(blocks, centre, q)

    trace = float(_added(blocks, dim, 1, lambda x: np.array([np.square(centre.centred(x)).sum()]))[0]) / n
    values, vectors = subspace(product, dim, components)
    real = values > RANK * max(values[0], 0.0)
    model = Whitening(dim, n, sums, vectors[:, real], values[real], trace, 0.0, passes[0])
    k = int(real.sum())
    if k:
        white = lambda x: centre.centred(x) @ model.vectors / np.sqrt(model.values)
        middle = _added(blocks, dim, k, lambda x: white(x).sum(axis=0)) / n

        def spread(x):
            w = white(x) - middle
            return (w.T @ w).ravel()
        found = _added(blocks, dim, k * k, spread).reshape(k, k) / n
        model.identity_error = float(np.abs(found - np.eye(k)).max())
    return model


def transform(quantised: DataFrame, model: Whitening, id_type: str) -> DataFrame:
    """``__id, component, n, deviation, whitened, explained, identity_error`` of
    every row of the model's length and every component."""
    k, centre = len(model.values), Centre(model.n, model.sums)

    def run(batches):
        for batch in batches:
            ids, step = column(batch, "__id"), max(1, BLOCK_BYTES // (8 * max(model.dim, k)))
            x = _matrix(batch, "__x") if batch.num_rows else np.empty((0, model.dim), np.int64)
            for a in range(0, len(x), step):
                part = x[a:a + step]
                m = len(part)
                white = centre.centred(part) @ model.vectors / np.sqrt(model.values)
                square = pa.array([v if v < 1 << 63 else None for v in centre.squares(part)], pa.int64())
                row = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch([
                    ids.slice(a, m).take(row), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n), pa.int64()),
                    square.take(row), pa.array(white.ravel()), pa.array(np.tile(model.values / model.trace, m)),
                    pa.array(np.full(m * k, model.identity_error))],
                    names=["__id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = f"__id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return quantised.filter(F.size("__x") == model.dim).mapInArrow(run, schema)


def whiten(vectors: DataFrame, components: int = 16, scale: float = 64, offset: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: a
    row for each vector that takes part and each of the largest ``components``."""
    rows = quantise(vectors, id_col, vector_col, scale, offset)
    id_type = vectors.schema[id_col].dataType.simpleString()
    model = fit(rows, components)
    if model is None or not len(model.values):
        model = Whitening(0, 1, [0], np.zeros((0, 0)), np.zeros(0), 1.0, 0.0, 0)
    return transform(rows, model, id_type).withColumnRenamed("__id", id_col)
