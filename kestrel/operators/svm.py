"""Support vector classification on explicit features, all grid points and folds at once.

Minimises |w|^2 / (2 C n) + mean(max(0, 1 - s f(x).w)^2) with a free intercept, s = 1 or -1, over
the rows of the training folds, by Newton steps.  A step is ONE aggregate of loss, gradient and
Hessian for every (feature map, C, held-out fold); only these sums, (features + 1)^2 numbers a
fit, reach the driver.  A step that raises the objective is halved.  On more than ``WARM_ROWS`` rows the steps
start from the fits on about so many of them, drawn by a hash, and end at the same tolerance on all rows.

Feature maps: the inputs; ``nystroem`` for RBF kernels (landmarks drawn by seeded leverage scores of a bounded
sample, whitened by an eigendecomposition); ``tensor_sketch`` for polynomial kernels (count sketches
of the inputs multiplied in the Fourier domain, Pham & Pagh 2013).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import ship_package, stored


WARM_ROWS = 100_000


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-gamma * np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0))


def nystroem(sample: np.ndarray, gamma: float, m: int, seed: int = 0) -> Callable:
    """Map to at most ``m`` features whose inner products approximate the RBF kernel.

    Landmarks are rows of ``sample``, drawn without replacement by their ridge leverage scores."""
    k = rbf(sample, sample, gamma)
    scores = np.clip(np.diag(k @ np.linalg.inv(k + 1e-3 * len(k) * np.eye(len(k)))), 1e-12, None)
    m = min(m, len(sample))
    chosen = np.sort(np.random.default_rng(seed).choice(len(sample), m, replace=False, p=scores / scores.sum()))
    marks = sample[chosen]
    values, vectors = np.linalg.eigh(rbf(marks, marks, gamma))
    good = values > 1e-10 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    return lambda x: rbf(x, marks, gamma) @ whiten


def tensor_sketch(n_in: int, gamma: float, degree: int = 3, size: int = 128, seed: int = 0) -> Callable:
    """Map whose inner products estimate (gamma x.y + 1)^degree."""
    r = np.random.default_rng(seed)
    place = r.integers(0, size, (degree, n_in + 1))
    sign = r.choice([-1.0, 1.0], (degree, n_in + 1))

    def features(x):
        x = np.column_stack([np.sqrt(gamma) * x, np.ones(len(x))])
        out = np.ones((len(x), size // 2 + 1), complex)
        for p, s in zip(place, sign):
            sketch = np.zeros((len(x), size))
            for j in range(n_in + 1):
                sketch[:, p[j]] += s[j] * x[:, j]
            out *= np.fft.rfft(sketch, axis=1)
        return np.fft.irfft(out, size, axis=1)
    return features


def linear(x: np.ndarray) -> np.ndarray:
    return x


def bounded_sample(df: DataFrame, feats: list[str], rows: int = 1000, seed: int = 0) -> np.ndarray:
    """``rows`` rows of ``feats`` with the least seeded hash: the same for any cut of the table."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in feats]).dropna().withColumn("_h", F.xxhash64(F.lit(seed), *feats))
    return d.orderBy("_h", *feats).limit(rows).drop("_h").toPandas().to_numpy(np.float64)


class Svm:
    """Fits of every (map, C, held-out fold); fold -1 holds out nothing.  Rows with a null are left out."""

    def __init__(self, df: DataFrame, feats: list[str], label: str, maps: dict[str, Callable], cs: list[float],
                 fold_col: str | None = None, folds: list[int] = (-1,), tol: float = 1e-6, max_steps: int = 100):
        ship_package(df.sparkSession)
        self.feats, self.maps = feats, maps
        fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
        self._rows = stored(df.select(*[F.col(c).cast("double").alias(c) for c in feats], F.col(label).cast("double").alias("_y"),
                                           fold.alias("_fold")).dropna())
        self.fits = [(name, c, f) for name in maps for c in cs for f in folds]
        self.weights: dict[tuple, np.ndarray] = {}
        self.gradient: dict[tuple, float] = {}
        self._solve(tol, max_steps, self._start(tol, max_steps))

    def _start(self, tol: float, max_steps: int) -> dict[tuple, np.ndarray]:
        """Weights to start from: those of the fits on a hashed sample, or nothing on few rows."""
        whole, n = self._rows, self._rows.count()
        if n <= WARM_ROWS:
            return {}
        self._rows = stored(whole.where(F.pmod(F.xxhash64(F.lit(1), *whole.columns), F.lit(n // WARM_ROWS + 1)) == 0))
        try:
            self._solve(tol, max_steps, {})
            return self.weights
        except RuntimeError:
            return {}
        finally:
            self._rows, self.weights, self.gradient = whole, {}, {}

    def _sums(self, points: list[tuple[tuple, np.ndarray]]) -> dict[tuple, np.ndarray]:
        feats, maps = self.feats, self.maps
        wanted = [(name, f, w) for (name, _, f), w in points]

        def run(batches):
            import pyarrow as pa
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                x = np.column_stack([b.column(c).to_numpy() for c in feats])
                s, fold = 2 * b.column("_y").to_numpy() - 1, b.column("_fold").to_numpy()
                made = {name: np.column_stack([np.ones(len(x)), f(x)]) for name, f in maps.items() if len(x)}
                for i, (name, held, w) in enumerate(wanted):
                    if not len(x):
                        continue
                    z = made[name]
                    slack = 1 - s * (z @ w)
                    use = (slack > 0) & (fold != held)
                    za, sl = z[use], slack[use]
                    v = np.concatenate([[(fold != held).sum(), sl @ sl], -2 * ((s[use] * sl) @ za), 2 * (za.T @ za).ravel()])
                    sums[i] = sums[i] + v if i in sums else v
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                             names=["fit", "sums"])

        def add(t):
            import pyarrow as pa
            total = sum(np.frombuffer(v.as_buffer()) for v in t.column("sums"))
            return pa.table({"fit": pa.array([t.column("fit")[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})
        shape = "fit int, sums binary"
        got = self._rows.mapInArrow(run, shape).groupBy("fit").applyInArrow(add, shape).collect()
        return {points[r[0]][0]: np.frombuffer(r[1]) for r in got}

    def _solve(self, tol: float, max_steps: int, start: dict[tuple, np.ndarray]) -> None:
        sample = np.zeros((1, len(self.feats)))
        size = {name: f(sample).shape[1] + 1 for name, f in self.maps.items()}
        state = {fit: dict(w=start.get(fit, np.zeros(size[fit[0]])), step=None, best=None) for fit in self.fits}
        for _ in range(max_steps):
            todo = [fit for fit in self.fits if fit not in self.weights]
            if not todo:
                return
            sums = self._sums([(fit, state[fit]["w"]) for fit in todo])
            for fit in todo:
                s, k = state[fit], size[fit[0]]
                if fit not in sums or not sums[fit][0]:
                    self.weights[fit], self.gradient[fit] = s["w"], 0.0  # no rows
                    continue
                n, v = sums[fit][0], sums[fit][1:] / sums[fit][0]
                ridge = np.full(k, 1 / (fit[1] * n))
                ridge[0] = 0.0
                value = v[0] + (ridge * s["w"] ** 2).sum() / 2
                if s["step"] is not None and value > s["best"][1] * (1 + 1e-12) and np.abs(s["step"]).max() > 1e-14:
                    s["step"] = s["step"] / 2
                    s["w"] = s["best"][0] + s["step"]
                    continue
                grad = v[1:1 + k] + ridge * s["w"]
                norm = float(np.abs(grad).max())
                if norm <= tol or s["step"] is not None and np.abs(s["step"]).max() <= 1e-14:
                    self.weights[fit], self.gradient[fit] = s["w"], norm
                    continue
                hess = v[1 + k:].reshape(k, k) + np.diag(ridge)
                hess[np.diag_indices(k)] += 1e-10
                s["best"], s["step"] = (s["w"], value), -np.linalg.solve(hess, grad)
                s["w"] = s["w"] + s["step"]
        raise RuntimeError("support vector classification did not converge")

    def accuracy(self, df: DataFrame, label: str, fold_col: str | None = None) -> dict[tuple, float]:
        """(map, C, fold) -> share of right signs, of all fits in one pass: per fold by the fit that held it out, or
        without ``fold_col`` of the fits on all rows (fold -1).  Rows with a null count nowhere."""
        maps, feats = self.maps, self.feats
        fits = [fit for fit in self.fits if (fit[2] >= 0) == bool(fold_col)]
        weights = [self.weights[fit] for fit in fits]

        def run(batches):
            import pyarrow as pa
            sums = np.zeros((2, len(fits)), np.int64)
            for b in batches:
                x = np.column_stack([b.column(n).to_numpy() for n in feats])
                fold, y = b.column("_fold").to_numpy(), b.column("_y").to_numpy()
                for name, f in maps.items():
                    if not len(x):
                        continue
                    z = np.column_stack([np.ones(len(x)), f(x)])
                    for i, ((own, _, held), w) in enumerate(zip(fits, weights)):
                        if own == name:
                            use = fold == held
                            sums[:, i] += ((z[use] @ w > 0) == (y[use] > 0.5)).sum(), use.sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), *map(pa.array, sums)], names=["fit", "good", "n"])
        d = df.select(*[F.col(c).cast("double").alias(c) for c in feats], F.col(label).cast("double").alias("_y"),
                      (F.col(fold_col) if fold_col else F.lit(-1)).cast("int").alias("_fold")).dropna()
        got = d.mapInArrow(run, "fit int, good long, n long").groupBy("fit").agg(F.sum("good"), F.sum("n")).collect()
        return {fits[i]: good / n for i, good, n in got if n}

    def margins(self, df: DataFrame, name: str, c: float, fold_col: str | None = None, out: str = "margin") -> DataFrame:
        """``df`` with the margin of each row: of the fit on all rows, or with ``fold_col`` of the fit that held out
        the row's fold.  A row with a null feature has a null margin."""
        f, feats = self.maps[name], self.feats
        weights = {h: self.weights[name, c, h] for n, k, h in self.fits if (n, k) == (name, c)}

        def run(batches):
            import pyarrow as pa
            for b in batches:
                x = np.column_stack([b.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in feats])
                fold = b.column(fold_col).to_numpy() if fold_col else np.full(len(x), -1)
                m = np.full(len(x), np.nan)
                for h, w in weights.items():
                    use = (fold == h) & ~np.isnan(x).any(axis=1)
                    if use.any():
                        m[use] = np.column_stack([np.ones(use.sum()), f(x[use])]) @ w
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m, mask=np.isnan(m))], names=[*b.schema.names, out])
        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))
