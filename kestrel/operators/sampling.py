"""Splits, shuffles, folds and training-size prefixes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.order import row_number


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Seeded random split (Bernoulli per row; sizes are approximate)."""
    return df.randomSplit(weights, seed)


def split_by_key(df: DataFrame, key: str, train_frac: float, buckets: int = 100) -> DataFrame:
    """Deterministic split on an integer key: ``key % buckets < frac * buckets`` is train."""
    return df.withColumn("split", F.when(F.col(key) % buckets < int(round(train_frac * buckets)), F.lit("train"))
                         .otherwise(F.lit("test")))


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    """Random order (a range shuffle on a seeded random key)."""
    return df.orderBy(F.rand(seed))


def fold_prefixes(df: DataFrame, order_cols: list, k: int, sizes: list[int]) -> DataFrame:
    """Rows of the first ``size`` training rows of each contiguous fold split.

    For validation fold f the training rows are the other folds, in order.  Their first
    max(sizes) rows are one or two intervals of row numbers, computed from the number of
    rows; only rows inside such an interval meet the fold and size lists, which
    have 2 k rows and one row per size.
    """
    n = row_number(df, [], order_cols, "_rn")
    count, most = df.count(), max(sizes)
    spans, at = [], 0
    for f in range(k):
        size = count // k + (f < count % k)
        before = min(at, most)  # training rows in front of the fold
        spans += [(f, 1, before, 0), (f, at + size + 1, min(count, at + size + most - before), size)]
        at += size
    spans = [x for x in spans if x[1] <= x[2]]
    if not spans:
        spans = [(0, 1, 0, 0)]
    fold = df.sparkSession.createDataFrame(spans, "fold long, _lo long, _hi long, _skip long")
    inside = [(F.col("_rn") >= lo) & (F.col("_rn") <= hi) for _, lo, hi, _ in spans]
    x = n.where(reduce(lambda a, b: a | b, inside)).join(
        F.broadcast(fold), (F.col("_rn") >= F.col("_lo")) & (F.col("_rn") <= F.col("_hi")))
    sz = df.sparkSession.createDataFrame([(s,) for s in sizes], "size int")
    x = x.withColumn("_pos", F.col("_rn") - F.col("_skip"))
    return x.join(F.broadcast(sz), F.col("_pos") <= F.col("size")).drop("_rn", "_lo", "_hi", "_skip", "_pos")
