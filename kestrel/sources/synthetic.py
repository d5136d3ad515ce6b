"""Synthetic 2-D sets and meshes, generated on executors from table rows.

Point i of n comes from the i-th row (distributed row number) of a driver
table, so the set grows with the data it is derived from.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.order import row_number


def _numbered(base: DataFrame, key: str) -> DataFrame:
    n = row_number(base.select(key), [], [key], "_i")
    return n.withColumn("_i", F.col("_i") - 1).crossJoin(F.broadcast(base.agg(F.count(F.lit(1)).alias("_n"))))


def moons(base: DataFrame, key: str, noise: float = 0.0, seed: int = 0) -> DataFrame:
    """Two interleaving half circles: first n//2 rows outer (class 0), rest inner (class 1)."""
    d = _numbered(base, key)
    n_out = (F.col("_n") / 2).cast("long")
    n_in = F.col("_n") - n_out
    outer = F.col("_i") < n_out
    t = F.when(outer, F.lit(math.pi) * F.col("_i") / F.greatest(n_out - 1, F.lit(1))) \
         .otherwise(F.lit(math.pi) * (F.col("_i") - n_out) / F.greatest(n_in - 1, F.lit(1)))
    x = F.when(outer, F.cos(t)).otherwise(1 - F.cos(t))
    y = F.when(outer, F.sin(t)).otherwise(1 - F.sin(t) - 0.5)
    if noise:
        x, y = x + F.randn(seed) * noise, y + F.randn(seed + 1) * noise
    return d.select(key, x.alias("x"), y.alias("y"), F.when(outer, 0).otherwise(1).alias("label"))


def circles(base: DataFrame, key: str, factor: float = 0.5, noise: float = 0.0, seed: int = 0) -> DataFrame:
    """Two concentric circles (inner radius ``factor``), angles evenly spaced without the end point."""
    d = _numbered(base, key)
    n_out = (F.col("_n") / 2).cast("long")
    n_in = F.col("_n") - n_out
    outer = F.col("_i") < n_out
    t = F.when(outer, F.lit(2 * math.pi) * F.col("_i") / n_out) \
         .otherwise(F.lit(2 * math.pi) * (F.col("_i") - n_out) / n_in)
    r = F.when(outer, F.lit(1.0)).otherwise(F.lit(factor))
    x, y = F.cos(t) * r, F.sin(t) * r
    if noise:
        x, y = x + F.randn(seed) * noise, y + F.randn(seed + 1) * noise
    return d.select(key, x.alias("x"), y.alias("y"), F.when(outer, 0).otherwise(1).alias("label"))


def linear_blobs(base: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """Two-feature linearly separable classes plus uniform jitter (random)."""
    d = base.select(key, F.randn(seed).alias("x"), F.randn(seed + 1).alias("y"))
    lab = ((F.col("x") + F.col("y")) > 0).cast("int")
    return d.select(key, (F.col("x") + 2 * F.rand(seed + 2)).alias("x"),
                    (F.col("y") + 2 * F.rand(seed + 3)).alias("y"), lab.alias("label"))


def mesh(df: DataFrame, xcol: str, ycol: str, steps: int = 50, margin: float = 0.0) -> DataFrame:
    """steps x steps grid over the data ranges (bounds from one aggregate)."""
    b = df.agg(F.min(xcol).alias("x0"), F.max(xcol).alias("x1"), F.min(ycol).alias("y0"), F.max(ycol).alias("y1"))
    g = b.select(F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"), "x0", "x1", "y0", "y1")
    g = g.select("i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("j"), "x0", "x1", "y0", "y1")
    return g.select((F.col("x0") - margin + (F.col("x1") - F.col("x0") + 2 * margin) * F.col("i") / (steps - 1)).alias(xcol),
                    (F.col("y0") - margin + (F.col("y1") - F.col("y0") + 2 * margin) * F.col("j") / (steps - 1)).alias(ycol))
