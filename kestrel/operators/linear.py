"""Closed-form linear models from aggregates (one pass over the rows).

Per (group, fold) the sufficient statistics are summed on executors; model
fits, cross-validation scores and best-parameter choice then run on those
small tables.  A fold's training sums are total minus the fold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.order import with_contiguous_folds

# Ridge penalty grid of the scans.
RIDGE_ALPHAS = [0.01, 0.1, 1.0]


def fold_sums_uni(rows: DataFrame, group_cols: list[str], features: list[str], target: str,
                  order_cols: list, k: int = 5, dense_col: str | None = None) -> DataFrame:
    """(group..., feature, fold, n, sy, syy, sxx, sxy) with contiguous folds."""
    f = with_contiguous_folds(rows, group_cols, order_cols, k, dense_col=dense_col)
    y = F.col(target)
    sums = f.groupBy(*group_cols, "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"),
        *[F.sum(F.col(x) * F.col(x)).alias(f"xx__{x}") for x in features],
        *[F.sum(F.col(x) * y).alias(f"xy__{x}") for x in features])
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"xx__{x}").alias("sxx"),
                                         F.col(f"xy__{x}").alias("sxy")) for x in features]))
    return (sums.select(*group_cols, "fold", "n", "sy", "syy", cells.alias("_c"))
                .select(*group_cols, F.col("_c.feature").alias("feature"), "fold", "n", "sy", "syy",
                        "_c.sxx", "_c.sxy"))


def ridge_uni_cv(fold_sums: DataFrame, group_cols: list[str], alphas=RIDGE_ALPHAS) -> DataFrame:
    """Univariate ridge without intercept: beta = Sxy / (Sxx + alpha).

    Fold score = r2 on the held-out fold with beta from the other folds;
    best alpha = highest mean fold score, first alpha on ties; reported r2 is
    the refit on all rows scored on those same rows.
    """
    keys = [*group_cols, "feature"]
    wt = Window.partitionBy(*keys)
    s = fold_sums.withColumns({"T" + c: F.sum(c).over(wt) for c in ["n", "sy", "syy", "sxx", "sxy"]})
    al = fold_sums.sparkSession.createDataFrame([(i, float(a)) for i, a in enumerate(alphas)],
                                                "alpha_idx int, alpha double")
    g = s.crossJoin(F.broadcast(al))
    beta = F.try_divide(F.col("Tsxy") - F.col("sxy"), F.col("Tsxx") - F.col("sxx") + F.col("alpha"))
    ssres = F.col("syy") - 2 * beta * F.col("sxy") + beta * beta * F.col("sxx")
    sstot = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    g = g.select("*", (F.lit(1.0) - F.try_divide(ssres, sstot)).alias("_r2"))
    cv = g.groupBy(*keys, "alpha_idx", "alpha").agg(
        F.avg("_r2").alias("cv_r2"),
        *[F.first("T" + c).alias("T" + c) for c in ["n", "sy", "syy", "sxx", "sxy"]])
    wb = Window.partitionBy(*keys).orderBy(F.col("cv_r2").desc_nulls_last(), F.col("alpha_idx"))
    best = cv.withColumn("_rk", F.row_number().over(wb)).where("_rk = 1")
    b = F.try_divide(F.col("Tsxy"), F.col("Tsxx") + F.col("alpha"))
    ssres_t = F.col("Tsyy") - 2 * b * F.col("Tsxy") + b * b * F.col("Tsxx")
    sstot_t = F.col("Tsyy") - F.col("Tsy") * F.col("Tsy") / F.col("Tn")
    return best.select(*keys, F.col("alpha").alias("best_alpha"), b.alias("beta"),
                       (F.lit(1.0) - F.try_divide(ssres_t, sstot_t)).alias("r2_train"),
                       F.col("Tn").alias("n_rows"))


# ---------------------------------------------------------------------------
# Multivariate ridge/OLS from Gram sums (k x k per group; solved on the driver,
# the matrices are fixed-size, never data-sized).
# ---------------------------------------------------------------------------

def gram_sums(rows: DataFrame, group_cols: list[str], features: list[str], target: str) -> DataFrame:
    """One row per group: n, sum y, sum y^2, X'y (k) and X'X (k(k+1)/2)."""
    y = F.col(target)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(F.col(a) * y).alias(f"xy__{i}") for i, a in enumerate(features)]
    aggs += [F.sum(F.col(a)).alias(f"x__{i}") for i, a in enumerate(features)]
    for i, a in enumerate(features):
        for j in range(i, len(features)):
            aggs.append(F.sum(F.col(a) * F.col(features[j])).alias(f"xx__{i}__{j}"))
    return rows.groupBy(*group_cols).agg(*aggs)


def unpack_gram(row, k: int):
    xx = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            xx[i, j] = xx[j, i] = row[f"xx__{i}__{j}"] or 0.0
    xy = np.array([row[f"xy__{i}"] or 0.0 for i in range(k)])
    xs = np.array([row[f"x__{i}"] or 0.0 for i in range(k)])
    return dict(n=row["n"] or 0, sy=row["sy"] or 0.0, syy=row["syy"] or 0.0, xx=xx, xy=xy, xs=xs)


def ridge_solve(g: dict, alpha: float) -> np.ndarray:
    k = g["xx"].shape[0]
    return np.linalg.solve(g["xx"] + alpha * np.eye(k), g["xy"])


def r2_from_sums(g: dict, beta: np.ndarray) -> float:
    ssres = g["syy"] - 2 * beta @ g["xy"] + beta @ g["xx"] @ beta
    sstot = g["syy"] - g["sy"] ** 2 / g["n"] if g["n"] else float("nan")
    return float(1 - ssres / sstot) if sstot else float("nan")


def r2_with_intercept(g: dict, w: np.ndarray) -> float:
    """r2 of intercept w[0] and slopes w[1:] on the rows summed in ``g``."""
    a, b = w[0], w[1:]
    ssres = (g["syy"] - 2 * a * g["sy"] - 2 * b @ g["xy"] + g["n"] * a * a + 2 * a * (b @ g["xs"]) + b @ g["xx"] @ b)
    sstot = g["syy"] - g["sy"] ** 2 / g["n"] if g["n"] else float("nan")
    return float(1 - ssres / sstot) if sstot else float("nan")


def add(a: dict, b: dict, sign: float = 1.0) -> dict:
    return dict(n=a["n"] + sign * b["n"], sy=a["sy"] + sign * b["sy"], syy=a["syy"] + sign * b["syy"],
                xx=a["xx"] + sign * b["xx"], xy=a["xy"] + sign * b["xy"], xs=a["xs"] + sign * b["xs"])


def ridge_cv_from_folds(folds: dict[int, dict], alphas=RIDGE_ALPHAS) -> tuple[float, np.ndarray, list]:
    """Best alpha by mean held-out r2 (first on ties), refit beta on all folds."""
    total = None
    for g in folds.values():
        total = g if total is None else add(total, g)
    scores = []
    for a in alphas:
        rs = []
        for g in folds.values():
            tr = add(total, g, -1.0)
            rs.append(r2_from_sums(g, ridge_solve(tr, a)))
        scores.append(float(np.mean(rs)))
    best = int(np.nanargmax(scores)) if not all(np.isnan(scores)) else 0
    return alphas[best], ridge_solve(total, alphas[best]), scores


# ---------------------------------------------------------------- least-angle path

def lars_path(g: dict) -> tuple[np.ndarray, np.ndarray]:
    """(alphas, slopes) at the knots of the lasso path of mean(err^2) / 2 + alpha * |w|_1 with a free
    intercept: least-angle steps on centred sums, a feature leaves where its slope meets zero
    (Efron et al. 2004).  Alphas fall from the first knot, where all slopes are zero, to 0;
    slopes are linear between knots.  A feature that depends on active ones never enters."""
    n, xs = g["n"], g["xs"]
    xx = g["xx"] / n - np.outer(xs, xs) / n ** 2
    xy = g["xy"] / n - xs * g["sy"] / n ** 2
    k = len(xs)
    w, active, barred = np.zeros(k), [], set(np.flatnonzero(np.diag(xx) <= 0).tolist())
    left = None  # the feature that has just left
    top = float(np.abs(xy[[j for j in range(k) if j not in barred]]).max(initial=0.0))
    alphas, slopes = [top], [w.copy()]
    alpha = top
    while alpha > 0:
        c = xy - xx @ w
        for j in sorted(set(range(k)) - set(active) - barred, key=lambda j: -abs(c[j])):
            if j != left and abs(c[j]) >= alpha * (1 - 1e-10):
                block = xx[np.ix_(active, active)]
                rest = xx[j, j] - (xx[j, active] @ np.linalg.solve(block, xx[active, j]) if active else 0.0)
                if rest <= 1e-12 * xx[j, j]:
                    barred.add(j)
                else:
                    active.append(j)
        left = None
        if not active:
            break
        sign = np.sign(c[active])
        step = np.linalg.solve(xx[np.ix_(active, active)], sign)  # slopes per unit of alpha
        fall = xx[:, active] @ step  # change of correlations
        size, leaving = alpha, None
        for j in set(range(k)) - set(active) - barred:
            for side in (1.0, -1.0):
                if 1 - side * fall[j] > 1e-14:
                    d = (alpha - side * c[j]) / (1 - side * fall[j])
                    if 1e-14 * top < d < size:
                        size, leaving = d, None
        for i, j in enumerate(active):
            if w[j] * step[i] < 0 and -w[j] / step[i] < size:
                size, leaving = -w[j] / step[i], j
        w[active] += size * step
        alpha = alpha - size if alpha - size > 1e-13 * top else 0.0
        if leaving is not None:
            w[leaving] = 0.0
            active.remove(leaving)
            left = leaving
        alphas.append(alpha)
        slopes.append(w.copy())
    return np.array(alphas), np.array(slopes)


def at_alpha(g: dict, path: tuple[np.ndarray, np.ndarray], alpha: float) -> np.ndarray:
    """(intercept, slopes) of a path at ``alpha``."""
    alphas, slopes = path
    w = np.array([np.interp(alpha, alphas[::-1], s[::-1]) for s in slopes.T])
    return np.concatenate([[(g["sy"] - w @ g["xs"]) / g["n"]], w])
