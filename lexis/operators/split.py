"""Deterministic stratified holdout, k-fold assignment and split checks.

Rows are ordered inside their class by ``md5('<seed>:<id>')`` — a
reproducible pseudo-random permutation that any engine can recompute.  The
rank uses ``bucketed_row_number`` keyed on the digest's first hex digits, so a
class holding a third of all rows is still ranked by thousands of tasks.

Quotas follow scikit-learn's contract: ``n_test = ceil(frac * N)`` split over
classes proportionally with the leftover rows going to the largest
remainders (ties to the smaller label), in exact integer arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.operators.rank import bucketed_row_number, hex_prefix_bucket


def hash_key(id_col: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def class_counts(df: DataFrame, label: str) -> list[tuple]:
    """Per-class row counts (one row per class: a bounded driver result)."""
    return sorted((r[0], r[1]) for r in df.groupBy(label).count().collect())


def largest_remainder(counts: list[tuple], total_take: int) -> dict:
    n = sum(c for _, c in counts)
    if n == 0:
        return {}
    floors = {k: (total_take * c) // n for k, c in counts}
    rems = sorted(counts, key=lambda kc: (-((total_take * kc[1]) % n), kc[0]))
    left = total_take - sum(floors.values())
    for k, _ in rems[:left]:
        floors[k] += 1
    return floors


def ranked(df: DataFrame, id_col: str, label: str, seed: int | str) -> DataFrame:
    keyed = df.withColumn("_key", hash_key(id_col, seed)).withColumn("_b", hex_prefix_bucket("_key"))
    return bucketed_row_number(keyed, [label], [F.asc("_key"), F.asc(id_col)], "_b", "_rank").drop("_b", "_key")


def _literal_map(d: dict, key_type: str, value_type: str) -> Column:
    if not d:
        return F.create_map().cast(f"map<{key_type},{value_type}>")
    flat = []
    for k, v in d.items():
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def stratified_split(df: DataFrame, id_col: str = "text_id", label: str = "label",
                     test_size: float = 0.2, seed: int | str = 42, out: str = "split") -> DataFrame:
    """Adds ``split`` in {'train', 'test'}.

    Only ``(id, label)`` is ranked, to find the last test row of each class; every
    row is then compared with its class's cutoff, so texts are not shuffled."""
    counts = class_counts(df, label)
    n = sum(c for _, c in counts)
    quotas = largest_remainder(counts, math.ceil(test_size * n))
    q = F.element_at(_literal_map(quotas, "int", "long"), F.col(label))
    last = (ranked(df.select(id_col, label), id_col, label, seed).where(F.col("_rank") == q)
            .select(label, hash_key(id_col, seed).alias("_key"), id_col).collect())  # one row per class
    test = F.lit(False)
    for value, key, ident in last:
        mine = hash_key(id_col, seed)
        test = test | ((F.col(label) == value) & ((mine < key) | ((mine == key) & (F.col(id_col) <= ident))))
    return df.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train")))


def stratified_kfold(df: DataFrame, id_col: str = "text_id", label: str = "label", n_splits: int = 5,
                     seed: int | str = 42, out: str = "fold") -> DataFrame:
    """Adds ``fold`` in [0, n_splits): ids sorted by (class, hash) dealt round-robin,
    so each class is spread evenly and fold sizes differ by at most one.

    Only ``(id, label)`` is counted, ranked and shuffled for that; wider rows then join
    the fold table by id, which adaptive execution broadcasts where it is small and
    which moves no wide row of a table that is bucketed by id.  Rows that repeat an id
    share its fold; rows with a null id or label are left out."""
    ids = df.select(id_col, label).distinct()
    counts = class_counts(ids.dropna(), label)
    if any(c < n_splits for _, c in counts):
        raise ValueError(f"n_splits={n_splits} is greater than the members of a class")
    offsets, acc = {}, 0
    for k, c in counts:
        offsets[k] = acc
        acc += c
    off = F.element_at(_literal_map(offsets, "int", "long"), F.col(label))
    folds = ranked(ids, id_col, label, seed).select(
        id_col, label, F.pmod(off + F.col("_rank") - 1, F.lit(n_splits)).cast("int").alias(out))
    return df.join(folds, [id_col, label]).select(*df.columns, out)


def inner_validation(train: DataFrame, id_col: str = "text_id", label: str = "label",
                     frac: float = 0.1, seed: int | str = "42:val", out: str = "is_validation") -> DataFrame:
    """Stratified 90/10 early-stopping split of the training part (boolean column)."""
    s = stratified_split(train, id_col, label, frac, seed, "_s")
    return s.withColumn(out, F.col("_s") == "test").drop("_s")


def leak_check(split: DataFrame, id_col: str = "text_id", col: str = "split") -> DataFrame:
    """train/test sizes and the number of ids present in both (must be 0).

    One ``groupBy(id)`` (partial aggregation) replaces a semi join of the two sides."""
    per_id = split.groupBy(id_col).agg(F.count_if(F.col(col) == "train").alias("_tr"),
                                       F.count_if(F.col(col) == "test").alias("_te"))
    return per_id.agg(F.sum("_tr").cast("long").alias("n_train"), F.sum("_te").cast("long").alias("n_test"),
                      F.count_if((F.col("_tr") > 0) & (F.col("_te") > 0)).cast("long").alias("n_overlap"))
