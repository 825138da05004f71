"""Nearest neighbours by vantage-point trees, one tree per shard.

Nearness is the largest cosine.  Vectors are scaled to length one, where the
Euclidean distance is a metric and falls as the cosine rises.  Vectors are dealt
to shards of about ``SHARD`` and queries to blocks of about ``BLOCK``; each
(shard, block) is a unit of bounded size that builds the shard's tree and walks
it with all queries of the block at once.  A subtree is left out for the queries
whose triangle-inequality bound, times ``factor``, exceeds the distance of their
k-th neighbour so far: factor 1 is exact search, larger factors prune more.
Per query, each shard returns at most k rows, merged by rank.

Queries are a stated set held against all rows in blocks.  Block products only
tell which candidates can be among the best, with room for rounding; those are
ranked by the cosine of their own two vectors in double precision, the score,
and equal scores go to the smaller id.  Vectors are first scaled by a power of
two, which changes no digit, so very long and very short ones compare alike.

Defined cases: vectors that are null, zero, or hold a null or non-finite
component, and rows without an id, take no part; a query id that is repeated is
searched once, by its first vector in array order; vectors of different lengths
are never compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD, BLOCK, LEAF = 8192, 1024, 256
SLACK = 1e-6  # rounding of distances near zero
NEAR = 1e-9  # rounding of a block product
PAIRS = 1 << 15


class Tree:
    """Vantage-point tree over unit vectors; a node is a vantage point, the
    range of distances of its near and far halves, and the halves."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.length = vectors, np.linalg.norm(vectors, axis=1)
        self.unit = unit = vectors / self.length[:, None]
        self.root = self._build(np.arange(len(unit)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        point, rest = rows[0], rows[1:]
        far = _distance(self.unit[rest] @ self.unit[point])
        split = np.argsort(far, kind="stable")
        half = len(rest) // 2
        halves = []
        for part in (split[:half], split[half:]):
            halves.append((far[part].min(), far[part].max(), self._build(rest[np.sort(part)])))
        return point, halves

    def nearest(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, factor: float):
        """Positions and cosines of the k nearest rows of each query (-1: none);
        ``own`` is each query's id, which is no candidate."""
        given, size = queries, np.linalg.norm(queries, axis=1)
        queries = queries / size[:, None]
        found = np.full((len(queries), k), -1, np.int64)
        score = np.full((len(queries), k), -np.inf)

        def offer(asks: np.ndarray, rows: np.ndarray):
            cosine = queries[asks] @ self.unit[rows].T
            cosine[ids[rows][None, :] == own[asks][:, None]] = -np.inf
            floor = score[asks, k - 1]
            if len(rows) > k:
                floor = np.maximum(floor, np.partition(cosine, len(rows) - k, axis=1)[:, -k])
            ask, row = np.nonzero((cosine >= floor[:, None] - NEAR) & (cosine > -np.inf))
            exact = np.full(cosine.shape, -np.inf)
            for a in range(0, len(ask), PAIRS):
                i, j = ask[a:a + PAIRS], row[a:a + PAIRS]
                product = np.einsum("ij,ij->i", given[asks[i]], self.vectors[rows[j]])
                exact[i, j] = product / (size[asks[i]] * self.length[rows[j]])
            every = np.concatenate([score[asks], exact], axis=1)
            where = np.concatenate([found[asks], np.broadcast_to(rows, exact.shape)], axis=1)
            name = np.where(where >= 0, ids[where], np.iinfo(np.int64).max)
            by_id = np.argsort(name, axis=1, kind="stable")
            shown = np.take_along_axis(every, by_id, 1)
            best = np.take_along_axis(by_id, np.argsort(-shown, axis=1, kind="stable")[:, :k], 1)
            score[asks], found[asks] = np.take_along_axis(every, best, 1), np.take_along_axis(where, best, 1)

        def walk(node, asks: np.ndarray):
            if not len(asks):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    offer(asks, node)
                return
            point, halves = node
            offer(asks, np.array([point]))
            away = _distance(queries[asks] @ self.unit[point])
            near_first = np.abs(away - (halves[0][0] + halves[0][1]) / 2) <= np.abs(away - (halves[1][0] + halves[1][1]) / 2)
            for first in (True, False):
                for side in ((0, 1) if first else (1, 0)):
                    low, high, child = halves[side]
                    mine = near_first == first
                    bound = np.maximum(np.maximum(low - away, away - high), 0.0)
                    reach = _distance(score[asks, k - 1])
                    walk(child, asks[mine & (bound * factor <= reach + SLACK)])

        walk(self.root, np.arange(len(queries)))
        found[np.isneginf(score)] = -1
        return found, score


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * np.maximum(cosine, -1e300), 0.0))


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    """The vectors, each scaled by the power of two that brings its largest entry to 0.5 .. 1."""
    values = table.column(name).combine_chunks()
    rows = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def _unit_search(k: int, factor: float):
    def run(key, rows: pa.Table, asks: pa.Table) -> pa.Table:
        out = {n: [] for n in ("query_id", "vec_id", "score")}
        if rows.num_rows and asks.num_rows:
            rows, asks = rows.sort_by([("__id", "ascending")]), asks.sort_by([("__ask_id", "ascending")])
            base, query = _matrix(rows, "__vector"), _matrix(asks, "__ask_vector")
            ids, own = rows.column("__id").to_numpy(), asks.column("__ask_id").to_numpy()
            mixed = np.random.default_rng(1).permutation(len(base))  # vantage points at random
            found, score = Tree(base[mixed]).nearest(query, ids[mixed], own, k, factor)
            ask, rank = np.nonzero(found >= 0)
            out = {"query_id": own[ask], "vec_id": ids[mixed[found[ask, rank]]], "score": score[ask, rank]}
        return pa.table({n: pa.array(v, pa.float64() if n == "score" else pa.int64()) for n, v in out.items()})
    return run


def _taking_part(vector: Column) -> Column:
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest other rows of every row
    of ``vectors`` for which ``queries`` (a condition on its columns) holds."""
    good = vectors.filter(F.col(id_col).isNotNull() & _taking_part(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("__id"), F.col(vector_col).cast("array<double>").alias("__vector"),
        F.coalesce(queries, F.lit(False)).alias("__ask")).withColumn("__dim", F.size("__vector"))
    rows, asking = good.agg(F.count("*"), F.sum(F.col("__ask").cast("int"))).first()
    shards, blocks = -(-rows // SHARD) or 1, -(-(asking or 0) // BLOCK) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = good.select("__id", "__vector", "__dim", F.pmod(F.xxhash64("__id"), F.lit(shards)).cast("int").alias("__shard"),
                       every(blocks).alias("__block"))
    # fresh names: the two sides of a cogroup must not share attributes
    asks = (good.filter("__ask").groupBy(F.col("__id").alias("__ask_id"), F.col("__dim").alias("__ask_dim"))
            .agg(F.min("__vector").alias("__ask_vector"))
            .withColumn("__ask_shard", every(shards))
            .withColumn("__ask_block", F.pmod(F.xxhash64("__ask_id"), F.lit(blocks)).cast("int")))
    found = base.groupBy("__dim", "__shard", "__block").cogroup(
        asks.groupBy("__ask_dim", "__ask_shard", "__ask_block")).applyInArrow(
        _unit_search(k, factor), "query_id long, vec_id long, score double")
    by_rank = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
