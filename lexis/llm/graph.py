"""Connected components of an edge table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.session import materialize


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)`` (longs): ``label`` is
    the smallest node reachable.

    Alternating large-star and small-star rounds: each hangs neighbours on the
    smallest neighbour seen, so the table never grows and ends as a forest of
    stars.  Minima are partial aggregates and the join back is one row per hub,
    which adaptive execution splits, so a hub of any degree is no single task's
    work.  Each round's edges are a written table; nothing is collected but
    whether a node still has two parents, or a parent and a child.
    """
    forest = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), name)
    while True:
        ends = forest.selectExpr("stack(2, hi, 1, lo, 0) as (node, child)").groupBy("node").agg(
            F.sum("child").alias("parents"), F.min("child").alias("leaf"))
        if ends.filter("parents > 1 or (parents = 1 and leaf = 0)").isEmpty():
            break  # stars already
        both = forest.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(forest.select("lo", "hi"))
        top = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(top, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .union(low.select("u", "m")).distinct())
        forest = materialize(small, name)
    return forest.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(
        forest.select("lo", "lo").distinct())
