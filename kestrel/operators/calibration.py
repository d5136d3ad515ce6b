"""Platt scaling: probabilities from margins.

P(1 | m) = 1 / (1 + exp(a m + b)) is fitted to the targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2)
(Platt 1999) by Newton steps; a step is one aggregate of six sums.  The margins should come from
models that have not seen their rows (``Svm.margins`` with a fold column).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


def platt(df: DataFrame, margin: str, label: str, tol: float = 1e-10, max_steps: int = 100) -> tuple[float, float]:
    """(a, b) of the sigmoid for margins and 0/1 labels; rows with a null in either are left out.  Without rows
    of both classes the smoothed targets still give a finite fit; without rows it is (0, 0)."""
    d = cut_lineage(df.select(F.col(margin).cast("double").alias("m"), F.col(label).cast("double").alias("y")).dropna())
    n, n1, centre, scale = d.agg(F.count(F.lit(1)), F.sum("y"), F.avg("m"), F.stddev_pop("m")).first()
    if not n:
        return 0.0, 0.0
    scale = scale or 1.0
    n0 = n - n1
    target = F.when(F.col("y") == 1, F.lit((n1 + 1) / (n1 + 2))).otherwise(F.lit(1 / (n0 + 2)))
    x = (F.col("m") - F.lit(centre)) / F.lit(scale)  # keeps the Newton step well scaled

    def sums(a, b):
        z = F.lit(a) * x + F.lit(b)
        p = 1 / (1 + F.exp(z))
        loss = target * z + F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        return np.array(d.agg(F.sum(loss), F.sum((target - p) * x), F.sum(target - p), F.sum(x * x * p * (1 - p)),
                              F.sum(x * p * (1 - p)), F.sum(p * (1 - p))).first(), float)
    w = np.array([0.0, math.log((n0 + 1) / (n1 + 1))])
    now = sums(*w.tolist())
    for _ in range(max_steps):
        grad = now[1:3]
        if np.abs(grad).max() <= tol * n:
            break
        step = -np.linalg.solve(np.array([[now[3], now[4]], [now[4], now[5]]]) + 1e-12 * n * np.eye(2), grad)
        if -(grad @ step) <= 1e-14 * max(now[0], 1.0):
            break  # nothing to win within rounding
        for _ in range(10):
            after = sums(*(w + step).tolist())
            if after[0] <= now[0] + 1e-4 * (grad @ step):
                break
            step = step / 2
        else:
            break  # the loss cannot be lowered any more
        w, now = w + step, after
    a = w[0] / scale
    return float(a), float(w[1] - a * centre)


def sigmoid(margin: Column, a: float, b: float) -> Column:
    return 1 / (1 + F.exp(F.lit(a) * margin + F.lit(b)))
