"""Exact ranks, running sums and per-group top-k without single-task windows.

A window ``partitionBy(label).orderBy(key)`` sends a whole class (possibly a
third of all rows) to one task, and a window with no partition sends
everything to one task.  These helpers instead split every ordered group into
``bucket`` sub-groups, where the bucket is a *monotone* function of the order
key (``bucket(a) < bucket(b)`` implies ``a < b``):

1. a window over ``(group, bucket)`` gives the local position / local sum;
2. ``groupBy(group, bucket)`` gives per-bucket totals — at most
   ``groups x buckets`` rows, a proven bound;
3. a window over that small table gives each bucket's offset;
4. a broadcast join adds the offset back.

The result equals the single-window result exactly, for any data.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_BUCKET_DIGITS = 3  # 16**3 = 4096 buckets for hash-ordered keys


def hex_prefix_bucket(hex_col: str | Column, digits: int = HEX_BUCKET_DIGITS) -> Column:
    """Monotone bucket of a lower-case hex string key (e.g. an md5 digest)."""
    c = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.conv(F.substring(c, 1, digits), 16, 10).cast("int")


def quantile_bucket(df: DataFrame, col: str, out: str, n_buckets: int = 1024,
                    rel_err: float = 1e-3) -> DataFrame:
    """Monotone bucket from approximate quantiles of ``col`` (splits are a
    bounded list of at most ``n_buckets + 1`` numbers on the driver)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.approxQuantile(col, probs, rel_err) if n_buckets > 1 else []
    splits = [float("-inf")] + sorted({q for q in qs if q == q}) + [float("inf")]
    if len(splits) < 3:  # no rows, or one bucket asked for
        return df.withColumn(out, F.lit(0))
    return Bucketizer(splits=splits, inputCol=col, outputCol=out,
                      handleInvalid="keep").transform(df).withColumn(out, F.col(out).cast("int"))


def _offsets(df: DataFrame, part: list[str], bucket: str, value_cols: dict[str, Column]) -> DataFrame:
    totals = df.groupBy(*part, bucket).agg(*[v.alias(k) for k, v in value_cols.items()])
    w = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    out = totals
    for k in value_cols:
        out = out.withColumn(f"_off_{k}", F.coalesce(F.sum(k).over(w), F.lit(0)))
    return out.drop(*value_cols.keys())


def bucketed_row_number(df: DataFrame, part: list[str], order: list[Column], bucket: str,
                        out: str = "rn") -> DataFrame:
    """Exact ``row_number() over (partition by part order by order)``."""
    local = df.withColumn("_lrn", F.row_number().over(Window.partitionBy(*part, bucket).orderBy(*order)))
    offs = _offsets(df, part, bucket, {"n": F.count(F.lit(1))})
    return (local.join(F.broadcast(offs), [*part, bucket])
            .withColumn(out, (F.col("_off_n") + F.col("_lrn")).cast("long"))
            .drop("_off_n", "_lrn"))


def bucketed_running_sum(df: DataFrame, part: list[str], order: list[Column], bucket: str,
                         sums: list[str], inclusive: bool = True, prefix: str = "cum_") -> DataFrame:
    """Exact running sums of ``sums`` in ``order`` within ``part``.

    ``inclusive=False`` gives the sum over strictly earlier rows."""
    frame = (Window.unboundedPreceding, 0) if inclusive else (Window.unboundedPreceding, -1)
    w = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(*frame)
    local = df
    for s in sums:
        local = local.withColumn(f"_l_{s}", F.coalesce(F.sum(s).over(w), F.lit(0)))
    offs = _offsets(df, part, bucket, {s: F.sum(s) for s in sums})
    out = local.join(F.broadcast(offs), [*part, bucket]) if part else local.join(F.broadcast(offs), [bucket])
    for s in sums:
        out = out.withColumn(prefix + s, F.col(f"_off_{s}") + F.col(f"_l_{s}")).drop(f"_off_{s}", f"_l_{s}")
    return out


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    salt: Column, salt_buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """Exact top-``k`` rows per group under a total ``order``.

    Stage 1 keeps the local top-k inside ``(group, salt)`` so a huge group is
    cut by ``salt_buckets`` tasks; stage 2 ranks the at most
    ``salt_buckets * k`` survivors per group."""
    salted = df.withColumn("_salt", F.pmod(salt, F.lit(salt_buckets)))
    stage1 = (salted.withColumn("_r1", F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order)))
              .where(F.col("_r1") <= k).drop("_r1", "_salt"))
    return (stage1.withColumn(rank_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
            .where(F.col(rank_col) <= k))


def bucketed_running_max(df: DataFrame, part: list[str], order: list[Column], bucket: str,
                         value: str, out: str) -> DataFrame:
    """Exact running maximum of ``value`` in ``order`` within ``part`` (same bucket scheme)."""
    w = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_lmax", F.max(value).over(w))
    totals = df.groupBy(*part, bucket).agg(F.max(value).alias("_bmax"))
    wb = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.withColumn("_prev", F.max("_bmax").over(wb)).drop("_bmax")
    return (local.join(F.broadcast(offs), [*part, bucket])
            .withColumn(out, F.greatest(F.col("_lmax"), F.col("_prev"))).drop("_lmax", "_prev"))


def value_counts(df: DataFrame, part: list[str], col: str) -> DataFrame:
    """``part, value, n``: the distinct non-null values of ``col`` with their
    counts (combined per task first); rows with a null in ``part`` are left out."""
    known = df.dropna(subset=[*part, col])
    return known.groupBy(*part, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def exact_percentiles(values: DataFrame, part: list[str], probs: list[float], out: str = "percentiles",
                      n_buckets: int = 1024) -> DataFrame:
    """``part, out`` with the interpolated percentiles of ``values(part, value, n)`` for
    one or more ``part`` columns, equal to ``percentile`` of the counted rows for any data.

    No value map is held in one task: the values are cut at approximate quantiles
    (a mergeable sketch gives at most ``n_buckets`` cuts), running counts are made
    per bucket, and the value at a rank is the smallest whose running count exceeds
    it.  ``values`` is read several times: pass a written table."""
    cut = quantile_bucket(values, "value", "_b", n_buckets)
    run = bucketed_running_sum(cut, part, [F.asc("value")], "_b", ["n"]).drop("_b")
    totals = values.groupBy(*part).agg(F.sum("n").alias("_total"))  # one row per group
    run = run.join(F.broadcast(totals), part)
    picks = []
    for p in probs:
        at = F.lit(float(p)) * (F.col("_total") - 1)
        picks += [F.min(F.when(F.col("cum_n") > rank, F.col("value"))) for rank in (F.floor(at), F.ceil(at))]
    got = run.groupBy(*part, "_total").agg(*[c.alias(f"_v{i}") for i, c in enumerate(picks)])
    points = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.col(f"_v{2 * i}").cast("double"), F.col(f"_v{2 * i + 1}").cast("double")
        points.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high))
    return got.select(*part, F.array(*points).alias(out))
