"""Mixing sources to target weights by subset-sum budget fitting.

Per source: documents are counted by exact size; whole copies of the source
cover the integral part of its target; of the remaining budget each size class
first gives its proportional share, rounded by a seeded cumulative rule so that
classes of one document take their turn at every size, and a bounded-knapsack
dynamic programme over the classes' leftover counts fits what is left as closely
as sums of sizes can.  The documents of a class are then chosen in seeded hash
order.

Scale: only (source, size) counts reach the fitting, one group per source (as
many rows as a source has distinct sizes); the programme's table is bounded by
``TABLE`` whatever the target.  Choosing k of c documents is a rank inside hash
buckets of about ``BUCKET`` documents, so a class that holds a third of all rows
is spread over c / BUCKET groups.

Defined cases: null text has size 0 (such documents are never repeated and take
0); a null source is a source, last in order; rows that repeat a doc_id are
separate documents; equal rows are interchangeable.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexis.llm.words import column, text_slices
from lexis.session import materialize

TABLE = 1 << 16
BUCKET = 1024


def _sizes(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in text_slices(batch):
                yield pa.record_batch({**{n: column(batch, n).slice(a, b - a) for n in names},
                                       "size": pa.array(words.counts, pa.int64())})
    return run


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to ``sources(source, source_size)``: ``share`` of all sizes
    is split by the weights (repeating, sources by code point, null last) and no
    target exceeds ``most`` times its source; the excess goes to the others by
    weight.  The table has one row per source.

    With sources in order of cap per weight, those that reach their cap come
    first, so the common level is found from running sums."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = (sources.withColumn("rank", F.row_number().over(order) - 1)
            .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
            .withColumn("cap", F.lit(float(most)) * F.col("source_size")))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    level = ((F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    rows = rows.withColumn("level", level)
    # the first source, in this order, whose cap is not reached sets the level
    rows = rows.withColumn("common", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        F.row_number().over(by_cap).alias("at"), "level"))).over(everything)["level"])
    return rows.withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("common") * F.col("weight"), F.col("cap")))).select(
        "source", "rank", "source_size", "target")


def proportional(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """Whole shares of the classes, about ``budget`` words in all and not above.

    The floor of a class's exact share is taken first.  The fractions that are
    left are summed over the classes in order of size; a class takes one more
    item each time its sum passes the next whole number after a seeded start.
    So neighbouring sizes take turns, and the extra items follow the sizes'
    spread instead of going to the longest; those that would pass the budget
    are given back, spread the same way."""
    total = int((sizes * counts).sum())
    share = [divmod(int(budget) * int(c), total) if s else (0, 0) for s, c in zip(sizes, counts)]
    take = np.array([whole for whole, _ in share], np.int64)
    order = np.argsort(sizes, kind="stable")
    start = int(np.random.default_rng(seed).integers(total))
    passed, extra = start, []
    for i in order:
        before, passed = passed // total, passed + share[i][1]
        if passed // total > before and take[i] < counts[i]:
            extra.append(i)
    take[extra] += 1
    over = int((take * sizes).sum()) - int(budget)
    for i in np.random.default_rng(seed + 1).permutation(np.array(extra, np.int64)):
        if over <= 0:
            break
        take[i] -= 1
        over -= int(sizes[i])
    return take


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int = 42) -> np.ndarray:
    """How many items of each size to take, ``counts`` at most.  Every class
    gives its proportional share first; what is left of the budget, at most a
    few items, is the largest sum the leftover counts can reach within it.  Where
    it is still above ``TABLE`` (items longer than that), leftover items are
    taken in a seeded order until it is below."""
    total = int((sizes * counts).sum())
    take = np.zeros(len(sizes), np.int64)
    if total == 0 or budget <= 0:
        return take
    if budget >= total:
        return np.where(sizes > 0, counts, 0)
    take = proportional(sizes, counts, budget, seed)
    rest = int(budget) - int((take * sizes).sum())
    for i in np.random.default_rng(seed + 2).permutation(len(sizes)):
        size, left = int(sizes[i]), int(counts[i] - take[i])
        if rest <= TABLE:
            break
        if size:
            more = min(left, -(-(rest - TABLE) // size), rest // size)
            take[i] += more
            rest -= more * size
    table = min(rest, TABLE)
    parts = []  # (class, copies): binary splitting of each leftover count
    for i in np.argsort(-sizes):  # long items first: the rest is filled by few
        size, left, step = int(sizes[i]), int(counts[i] - take[i]), 1
        left = min(left, table // size) if size else 0
        while left > 0:
            parts.append((i, min(step, left)))
            left -= min(step, left)
            step *= 2
    reached = np.full(table + 1, -1, np.int32)  # part that first reached the sum
    reached[0] = len(parts)
    for p, (i, copies) in enumerate(parts):
        jump = int(sizes[i]) * copies
        if jump <= table:
            fresh = (reached[:table + 1 - jump] >= 0) & (reached[jump:] < 0)
            reached[jump:][fresh] = p
        if reached[table] >= 0:
            break
    at = int(np.flatnonzero(reached >= 0)[-1])
    while at > 0:
        i, copies = parts[reached[at]]
        take[i] += copies
        at -= int(sizes[i]) * copies
    return take


def _fit(group: pd.DataFrame, seed: int) -> pd.DataFrame:
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    whole = int(target // size) if size else 0
    take = fit_budget(group["size"].to_numpy(), group["c"].to_numpy(), int(target - whole * size), seed)
    return pd.DataFrame({"rank": group["rank"], "size": group["size"], "c": group["c"], "whole": whole, "take": take})


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                seed: int = 42) -> DataFrame:
    """Every row of ``docs(doc_id, text, source, ...)`` without its text, with
    ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes of
    the document, repeats counted)."""
    names = [c for c in docs.columns if c not in ("text", "size", "source_size", "target", "taken")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields)
    draw = F.xxhash64(F.lit(seed), "doc_id", "text")
    given = docs.select("text", *names).withColumn("__draw", draw)
    sized = materialize(given.mapInArrow(_sizes([*names, "__draw"]), schema + ", __draw long, size long"), "sized")
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = materialize(plan, "targets")
    tagged = sized.join(plan.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    classes = tagged.groupBy("rank", "size", "source_size", "target").agg(F.count("*").alias("c"))
    chosen = materialize(classes.groupBy("rank").applyInPandas(
        lambda group: _fit(group.sort_values("size"), seed), "rank int, size long, c long, whole long, take long"), "chosen")
    bucket = F.pmod(F.shiftrightunsigned(F.col("__draw"), 8), F.ceil(F.col("c") / BUCKET)).alias("bucket")
    drawn = tagged.join(chosen, ["rank", "size"]).withColumn("bucket", bucket)
    part = drawn.filter("take > 0 and take < c")
    held = part.groupBy("rank", "size", "bucket", "take").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("rank", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    quota = held.select("rank", "size", "bucket", F.greatest(F.lit(0), F.least("n", F.col("take") - F.coalesce(
        F.sum("n").over(ahead), F.lit(0)))).alias("quota"))
    inside = W.partitionBy("rank", "size", "bucket").orderBy("__draw", F.col("doc_id").asc_nulls_last())
    part = part.join(quota, ["rank", "size", "bucket"]).withColumn(
        "extra", (F.row_number().over(inside) <= F.col("quota")).cast("long"))
    rest = drawn.filter("not (take > 0 and take < c)").withColumn("extra", (F.col("take") > 0).cast("long"))
    both = part.drop("quota").unionByName(rest)
    return both.select(*names, "size", "source_size", "target", (F.col("size") * (F.col("whole") + F.col("extra"))).alias("taken"))
