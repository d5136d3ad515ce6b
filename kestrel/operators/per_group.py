"""Many small models: ridge and lasso with folds and held-out rows for every data set of a family.

One aggregate gives the Gram sums of every (data set, fold), so a data set may have any number of
rows.  The sums of a data set, (folds + 1) x (features + 1)^2 numbers, meet in a row; an Arrow batch of such rows
is solved at once: stacked systems for ridge, vectorised coordinate descent for lasso, over all data sets,
folds and penalties together.

The chosen penalty has the highest mean r2 over the folds that have a score (the first on ties); a data
set without any score keeps the first.  r2 of constant rows is null, and so are scores without rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.linear import gram_sums
from kestrel.session import ship_package

OUT = ("model string, alpha double, cv_r2 double, train_r2 double, test_r2 double, n_train long, n_test long, "
       "intercept double, coef array<double>")


class Sums:
    """Stacked Gram sums: n, sy, syy (...), xs, xy (..., k), xx (..., k, k)."""

    def __init__(self, cells: np.ndarray, k: int):
        self.cells, self.k = cells, k
        self.n, self.sy, self.syy = cells[..., 0], cells[..., 1], cells[..., 2]
        self.xs, self.xy = cells[..., 3:3 + k], cells[..., 3 + k:3 + 2 * k]
        self.xx = cells[..., 3 + 2 * k:].reshape(*cells.shape[:-1], k, k)

    def centred(self):
        n = np.maximum(self.n, 1)
        return (self.xx - self.xs[..., :, None] * self.xs[..., None, :] / n[..., None, None],
                self.xy - self.xs * (self.sy / n)[..., None])

    def with_intercept(self, w: np.ndarray) -> np.ndarray:
        n = np.maximum(self.n, 1)
        return np.concatenate([((self.sy - (w * self.xs).sum(-1)) / n)[..., None], w], axis=-1)

    def r2(self, w: np.ndarray) -> np.ndarray:
        """r2 of intercepts w[..., 0] and slopes on these rows; NaN where it is not defined."""
        a, b = w[..., 0], w[..., 1:]
        err = (self.syy - 2 * a * self.sy - 2 * (b * self.xy).sum(-1) + self.n * a * a + 2 * a * (b * self.xs).sum(-1)
               + np.einsum("...i,...ij,...j->...", b, self.xx, b))
        spread = self.syy - self.sy ** 2 / np.maximum(self.n, 1)
        ok = (self.n > 0) & (spread > 1e-12 * np.abs(self.syy))
        return np.where(ok, 1 - err / np.where(ok, spread, 1), np.nan)


def ridge(s: Sums, alpha: float) -> np.ndarray:
    """Minimises |err|^2 + alpha |w|^2 with a free intercept, for every stacked system."""
    a, b = s.centred()
    a = a + max(alpha, 1e-9) * np.eye(s.k)
    return s.with_intercept(np.linalg.solve(a, b[..., None])[..., 0])


def lasso(s: Sums, alpha: float, tol: float = 1e-10, sweeps: int = 5000) -> np.ndarray:
    """Minimises mean(err^2) / 2 + alpha |w|_1 with a free intercept, for every stacked system."""
    a, b = s.centred()
    n = np.maximum(s.n, 1)
    a, b = a / n[..., None, None], b / n[..., None]
    w = np.zeros_like(b)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(s.k):
            own = a[..., j, j]
            rest = b[..., j] - np.einsum("...i,...i->...", a[..., j, :], w) + own * w[..., j]
            new = np.where(own > 1e-300, np.sign(rest) * np.maximum(np.abs(rest) - alpha, 0) / np.where(own > 1e-300, own, 1), 0)
            moved = max(moved, float(np.abs(new - w[..., j]).max(initial=0)))
            w[..., j] = new
        if moved <= tol * max(float(np.abs(w).max(initial=0)), 1e-300):
            break
    return s.with_intercept(w)


def search(df: DataFrame, key: str, feats: list[str], label: str, fold_col: str, folds: int,
           grids: dict[str, list[float]]) -> DataFrame:
    """(key, model, alpha, cv_r2, train_r2, test_r2, n_train, n_test, intercept, coef) for every data set and
    model of ``grids`` (ridge, lasso); fold -1 holds the held-out rows."""
    ship_package(df.sparkSession)
    k = len(feats)
    s = gram_sums(df.where(F.col(label).isNotNull()).dropna(subset=feats), [key, fold_col], feats, label)
    xx = [F.col(f"xx__{min(i, j)}__{max(i, j)}") for i in range(k) for j in range(k)]
    cells = F.array(F.col("n").cast("double"), "sy", "syy", *[F.col(f"x__{i}") for i in range(k)],
                    *[F.col(f"xy__{i}") for i in range(k)], *xx)
    rows = s.groupBy(key).agg(F.collect_list(F.struct(F.col(fold_col).cast("int").alias("fold"), cells.alias("cells"))).alias("parts"))
    solve = {"ridge": ridge, "lasso": lasso}
    size = 3 + 2 * k + k * k

    def run(batches):
        import pyarrow as pa

        def column(values, kind):
            return pa.array([None if isinstance(v, float) and np.isnan(v) else v for v in values], kind)
        for b in batches:
            got = np.zeros((b.num_rows, folds + 1, size))  # the last: held out
            for i, parts in enumerate(b.column("parts").to_pylist()):
                for p in parts:
                    got[i, p["fold"]] = p["cells"]
            own = Sums(got[:, :folds], k)
            total = Sums(got[:, :folds].sum(axis=1), k)
            rest = Sums(total.cells[:, None] - own.cells, k)
            test = Sums(got[:, folds], k)
            for model, alphas in grids.items():
                means = []
                for a in alphas:
                    r2 = own.r2(solve[model](rest, a))
                    r2 = np.where(rest.n > 0, r2, np.nan)
                    some = ~np.isnan(r2)
                    means.append(np.where(some.any(1), np.where(some, r2, 0).sum(1) / np.maximum(some.sum(1), 1), np.nan))
                means = np.array(means)
                best = np.where(np.isnan(means), -np.inf, means).argmax(axis=0)
                fits = np.array([solve[model](total, a) for a in alphas])
                at = np.arange(b.num_rows)
                w = fits[best, at]
                yield pa.RecordBatch.from_arrays([
                    b.column(key), pa.array([model] * b.num_rows), pa.array(np.array(alphas, float)[best]),
                    column(means[best, at].tolist(), pa.float64()), column(total.r2(w).tolist(), pa.float64()),
                    column(test.r2(w).tolist(), pa.float64()), pa.array(total.n.astype(np.int64)), pa.array(test.n.astype(np.int64)),
                    pa.array(w[:, 0]), pa.array(w[:, 1:].tolist(), pa.list_(pa.float64()))],
                    names=[key, "model", "alpha", "cv_r2", "train_r2", "test_r2", "n_train", "n_test", "intercept", "coef"])
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, {OUT}")
