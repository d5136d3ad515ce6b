"""Point-cloud array functions, as higher-order SQL functions.

A cloud is ``array<array<double>>`` of (x, y, z, intensity) points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Intensity threshold of the zero/non-zero split.
INTENSITY_EPS = 1e-8


def pad(points: Column, npoint: int) -> Column:
    """Zero-pad to ``npoint`` points (fails if the cloud is larger)."""
    zero = F.array(*[F.lit(0.0)] * 4)
    n = F.size(points)
    return F.when(n > npoint, F.raise_error(F.lit("cloud larger than npoint"))).otherwise(
        F.concat(points, F.array_repeat(zero, F.greatest(F.lit(npoint) - n, F.lit(0)))))


def rotation_matrix(alpha: float, beta: float, gamma: float) -> list[list[float]]:
    """Rz(alpha) . Ry(beta) . Rx(gamma) (as in the augmentation step)."""
    ca, sa, cb, sb, cg, sg = (math.cos(alpha), math.sin(alpha), math.cos(beta), math.sin(beta),
                              math.cos(gamma), math.sin(gamma))
    rz = [[ca, -sa, 0.0], [sa, ca, 0.0], [0.0, 0.0, 1.0]]
    ry = [[cb, 0.0, -sb], [0.0, 1.0, 0.0], [sb, 0.0, cb]]
    rx = [[1.0, 0.0, 0.0], [0.0, cg, -sg], [0.0, sg, cg]]

    def mm(a, b):
        return [[sum(a[i][k] * b[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    return mm(mm(rz, ry), rx)


def rotate(points: Column, m: list[list[float]]) -> Column:
    """xyz' = xyz . M^T (intensity kept)."""
    def one(p):
        xyz = [p[0], p[1], p[2]]
        rows = [sum((xyz[k] * F.lit(m[i][k]) for k in range(3)), F.lit(0.0)) for i in range(3)]
        return F.array(*rows, p[3])
    return F.transform(points, one)


def scale_intensity(points: Column, factor: Column) -> Column:
    return F.transform(points, lambda p: F.array(p[0], p[1], p[2], p[3] * factor))


def binarize_intensity(points: Column) -> Column:
    """Zero-intensity points first (intensity 0), then the others (intensity 1)."""
    zeros = F.transform(F.filter(points, lambda p: p[3] <= INTENSITY_EPS),
                        lambda p: F.array(p[0], p[1], p[2], F.lit(0.0)))
    ones = F.transform(F.filter(points, lambda p: p[3] > INTENSITY_EPS),
                       lambda p: F.array(p[0], p[1], p[2], F.lit(1.0)))
    return F.concat(zeros, ones)


def shuffle_tail(points: Column) -> Column:
    """Keep the first point, permute the rest (random: not reproducible by an oracle)."""
    return F.concat(F.slice(points, 1, 1), F.shuffle(F.slice(points, 2, 1 << 30)))


def drop_dim(points: Column) -> Column:
    return F.transform(points, lambda p: F.slice(p, 1, 3))


def transpose(points: Column, dims: int = 4) -> Column:
    """n x d -> d x n."""
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda j: F.transform(points, lambda p: p[j]))
