"""Model fitting on Spark.

Library estimators (``pyspark.ml``) cover linear, tree, forest, boosted, SVM,
naive Bayes and MLP models.  What they lack is built here from aggregates:
penalised least squares from Gram sums, support vector regression (one
aggregate per Newton step for all grid points), AdaBoost's weight update (a column expression between tree fits),
random Fourier features (a vector column), Gaussian discriminants (per-class
moments + a scoring expression).
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.neighbours import knn_votes  # noqa: F401  (part of this module's interface)
from kestrel.session import cut_lineage, discard, stored


def assemble(df: DataFrame, feats: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=feats, outputCol=out).transform(df)


# ---------------------------------------------------------------- registry

def regressor_zoo(label: str = "label") -> dict:
    """name -> (estimator, parameter grid) of the regressors that are fitted one by one."""
    dt = DecisionTreeRegressor(labelCol=label, seed=0)
    return {"tree": (dt, ParamGridBuilder().addGrid(dt.maxDepth, [3, 5]).build())}


def classifier_zoo(label: str = "label") -> dict:
    """name -> (estimator, parameter grid) of the classifiers that are fitted one by one."""
    lr = LogisticRegression(labelCol=label, maxIter=10)
    dt = DecisionTreeClassifier(labelCol=label, maxDepth=5, seed=0)
    svc = LinearSVC(labelCol=label, standardization=False, maxIter=20)
    nb = NaiveBayes(labelCol=label, modelType="gaussian")
    return {
        "logistic": (lr, ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).build()),
        "tree": (dt, ParamGridBuilder().build()),
        "linear_svc": (svc, ParamGridBuilder().addGrid(svc.regParam, [0.01]).build()),
        "naive_bayes": (nb, ParamGridBuilder().build()),
    }


def gram_search(folds: list[dict], test: dict, points: list[tuple[str, object]], score) -> list[tuple]:
    """Search rows (kind, grid_id, params, fold, score) of models fitted on Gram sums alone.

    ``points``: (params, fit from sums); ``score(sums, coefficients)`` is larger for better fits."""
    from kestrel.operators import linear
    total = functools.reduce(linear.add, folds)
    rows, means = [], []
    for g, (params, fit) in enumerate(points):
        cv = [score(own, fit(linear.add(total, own, -1.0))) for own in folds]
        means.append(float(np.mean(cv)))
        rows += [("fold", g, params, f, float(v)) for f, v in enumerate(cv)] + [("mean", g, params, None, means[-1])]
    best = int(np.argmax(means))
    w = points[best][1](total)
    return rows + [("train", best, points[best][0], None, float(score(total, w))),
                   ("test", best, points[best][0], None, float(score(test, w)))]


def fold_rows(folds: list[dict], test: dict, points: list[str], fits: list, score) -> list[tuple]:
    """Search rows as of ``gram_search``, for fits already made: of each of ``points`` the one on all rows, then those
    without each fold."""
    each = [fits[i:i + 1 + len(folds)] for i in range(0, len(fits), 1 + len(folds))]
    rows, means = [], []
    for g, (params, (_, *held_out)) in enumerate(zip(points, each, strict=True)):
        cv = [float(score(own, w)) for own, w in zip(folds, held_out, strict=True)]
        means.append(float(np.mean(cv)))
        rows += [("fold", g, params, f, v) for f, v in enumerate(cv)] + [("mean", g, params, None, means[-1])]
    best = int(np.argmax(means))
    whole = each[best][0]
    return rows + [("train", best, points[best], None, float(score(functools.reduce(_sum, folds), whole))),
                   ("test", best, points[best], None, float(score(test, whole)))]


def _sum(a: dict, b: dict) -> dict:
    from kestrel.operators import linear
    return linear.add(a, b)


def tree_search(train: DataFrame, test: DataFrame, feats: list[str], label: str, points: list, rounds: list[int],
                fold_col: str, folds: int, **options) -> list[tuple]:
    """Search rows (kind, grid_id, params, fold, score) of forests or boosting: every number of trees in
    ``rounds`` is a prefix of one fit, and all points and folds grow together."""
    from kestrel.operators import boosting as bo
    found, final, n = bo.search(train, feats, label, points, rounds, fold_col, folds, **options)
    rows = []
    for g, (p, r, own, mean) in enumerate(found):
        params = ", ".join(f"{k}={v}" for k, v in sorted({**vars(p), "trees": r}.items()))
        rows += [("fold", g, params, f, float(v)) for f, v in enumerate(own)] + [("mean", g, params, None, mean)]
    best = bo.best_of([x[3] for x in found])
    params = next(x[2] for x in rows if x[0] == "mean" and x[1] == best)
    for kind, part in (("train", train), ("test", test)):
        d = final.predict(part, final.fits[0], label, n)
        if options.get("metric") == "auc":
            rows.append((kind, best, params, None, _area(d, "_y", "_p")))
            continue
        if options.get("metric") == "accuracy":
            cut = 0.0 if options.get("loss") == "logistic" else 0.5
            score = F.avg(((F.col("_p") > cut) == (F.col("_y") > 0.5)).cast("double"))
        else:
            score = 1 - F.sum((F.col("_y") - F.col("_p")) ** 2) / (F.var_pop("_y") * F.count("_y"))
        rows.append((kind, best, params, None, float(d.agg(score).first()[0])))
    return rows


def _area(df: DataFrame, label: str, score: str) -> float:
    from kestrel.operators import metrics as mt
    area = mt.auc(df.select((F.col(label) > 0.5).cast("int").alias("_true"), score), "_true", score).first()[0]
    return float("nan") if area is None or area == mt.AUC_UNDEFINED else float(area)


def knn_search(train: DataFrame, test: DataFrame, feats: list[str], label: str, ks: list[int], algorithms: list[str],
               fold_col: str = "fold", folds: int = 5) -> list[tuple]:
    """Search rows (kind, grid_id, params, fold, score) of nearest-neighbour classifiers of a 0/1 label: area under the ROC
    curve of the share of the k nearest.  Every algorithm is exact and finds the same rows, so one index serves
    all; the distances of a fold are computed once for all ``ks``."""
    from kestrel.operators.boosting import best_of
    from kestrel.operators.neighbours import nearest

    def known(df):
        x = df.dropna(subset=[*feats, label]).select(*(c for c in df.columns if c == fold_col), F.col(label).alias("_label"), F.array(
            *[F.col(c).cast("double") for c in feats]).alias("_x"))
        return cut_lineage(x.withColumn("_id", F.monotonically_increasing_id()))
    train, test = known(train), known(test)

    def scores(own, rest):
        found = nearest(rest, own, max(ks), "_id", "_x", "_label")
        share = found.groupBy("_id").agg(*[F.avg(F.when(F.col("_rank") <= k, F.col("_y"))).alias(f"_p{k}") for k in ks])
        share = cut_lineage(own.select("_id", "_label").join(share, "_id").drop("_id"))
        return {k: _area(share, "_label", f"_p{k}") for k in ks}
    cv = [scores(train.where(F.col(fold_col) == f), train.where(F.col(fold_col) != f)) for f in range(folds)]
    points = [(f"algorithm={a}, n_neighbors={k}", k) for k in ks for a in algorithms]
    rows, means = [], []
    for g, (params, k) in enumerate(points):
        means.append(float(np.mean([own[k] for own in cv])))
        rows += [("fold", g, params, f, own[k]) for f, own in enumerate(cv)] + [("mean", g, params, None, means[-1])]
    best = best_of(means)
    return rows + [(kind, best, points[best][0], None, scores(part, train)[points[best][1]]) for kind, part in (("train", train), ("test", test))]


def cross_validate(est, grid, df: DataFrame, evaluator: Evaluator, fold_col: str | None = None,
                   k: int = 5, parallelism: int = 4, seed: int = 0):
    """k-fold CV (deterministic folds when ``fold_col`` is given), mean score, refit best."""
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator, numFolds=k,
                        parallelism=parallelism, seed=seed, foldCol=fold_col or "")
    return cv.fit(df)


# ---------------------------------------------------------------- linear summary

def linreg_summary(model) -> list[tuple[str, float]]:
    s = model.summary
    rows = [("intercept", float(model.intercept)), ("iterations", float(s.totalIterations)),
            ("rmse", float(s.rootMeanSquaredError)), ("mse", float(s.meanSquaredError)),
            ("mae", float(s.meanAbsoluteError)), ("r2", float(s.r2))]
    rows += [(f"coef_{i}", float(c)) for i, c in enumerate(model.coefficients)]
    rows += [(f"objective_{i}", float(v)) for i, v in enumerate(s.objectiveHistory)]
    return rows


# ---------------------------------------------------------------- penalised least squares

def elastic_net(g: dict, alpha: float, l1_ratio: float, tol: float = 1e-10, sweeps: int = 10_000) -> np.ndarray:
    """(intercept, slopes) that minimise mean(err^2) / 2 + alpha * (l1_ratio * |w|_1 + (1 - l1_ratio) / 2 * |w|^2)
    with a free intercept, by coordinate descent on the Gram sums ``g`` of ``linear.unpack_gram``.
    The proximal step sets coefficients exactly to zero; the loop ends when no coefficient
    moves by more than ``tol`` times the largest, and raises if it does not get there."""
    n, xs = g["n"], g["xs"]
    xx = g["xx"] / n - np.outer(xs, xs) / n ** 2  # centred second moments
    xy = g["xy"] / n - xs * g["sy"] / n ** 2
    w = np.zeros(len(xs))
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if xx[j, j] <= 0:
                continue
            rest = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - alpha * l1_ratio, 0.0) / (xx[j, j] + alpha * (1 - l1_ratio))
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= tol * max(np.abs(w).max(), 1e-300):
            return np.concatenate([[(g["sy"] - w @ xs) / n], w])
    raise RuntimeError("coordinate descent did not converge")


# ---------------------------------------------------------------- support vector regression

def _svr_sums(points, epsilon: float):
    """mapInPandas body: per batch and grid point the sums of loss, gradient and Hessian."""
    def run(batches):
        for b in batches:
            m = b.to_numpy(np.float64)
            whole, label, fold = np.column_stack([np.ones(len(m)), m[:, :-2]]), m[:, -2], m[:, -1]
            for p, (loss, w, mu, held_out) in points:
                x, y = (whole, label) if held_out < 0 else (whole[fold != held_out], label[fold != held_out])
                r = x @ w - y
                h, sign = np.maximum(np.abs(r) - epsilon, 0.0), np.sign(r)
                if loss == "squared_epsilon_insensitive":
                    val, first, second = h * h, 2 * h * sign, 2.0 * (h > 0)
                else:
                    root = np.sqrt(h * h + mu * mu)
                    val, first, second = root - mu, h / root * sign, (h > 0) * mu * mu / root ** 3
                sums = np.concatenate([[val.sum()], first @ x, (x.T @ (x * second[:, None])).ravel()])
                yield pd.DataFrame({"p": p, "i": np.arange(len(sums)), "v": sums})
    return run


def svr_fit(df: DataFrame, feats: list[str], label: str, grid: list[tuple[str, float]], epsilon: float = 0.0,
            tol: float = 1e-6, max_steps: int = 200, fold_col: str | None = None,
            folds: tuple[int, ...] = (-1,)) -> list[tuple[np.ndarray, float, float]]:
    """Linear support vector regression of every (loss, C) of ``grid`` on numeric columns:
    minimises |w|^2 / (2 C n) + mean(loss) with a free intercept by Newton steps.  With ``folds``, of every grid point
    and fold held out (-1: none), the folds of a point one after the other.

    Each step is ONE aggregate for all grid points: loss, gradient and Hessian, (k + 2)^2
    numbers a point.  The epsilon-insensitive loss is rounded off over a width that
    shrinks to 1e-4 as the steps settle; a step that raises the objective is
    halved.  Returns (coefficients, objective, gradient norm) per grid point, and raises
    if a gradient stays above ``tol``."""
    from kestrel.session import ship_package
    ship_package(df.sparkSession)
    fold = F.col(fold_col) if fold_col else F.lit(-1)
    d = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in (*feats, label)], fold.cast("double").alias("_fold")).dropna())
    sizes, k = dict(d.groupBy("_fold").count().collect()), len(feats) + 1
    grid, held_out = [x for x in grid for _ in folds], list(folds) * len(grid)
    count = [max(1, sum(c for f, c in sizes.items() if h < 0 or f != h)) for h in held_out]
    widths = [1.0, 0.1, 0.01, 1e-3, 1e-4]
    state = [{"w": np.zeros(k), "stage": 0 if loss == "epsilon_insensitive" else len(widths) - 1, "step": None,
              "best": None} for loss, _ in grid]
    out: list = [None] * len(grid)
    for _ in range(max_steps):
        todo = [p for p in range(len(grid)) if out[p] is None]
        if not todo:
            return out
        points = [(p, (grid[p][0], state[p]["w"], widths[state[p]["stage"]], held_out[p])) for p in todo]
        sums = d.mapInPandas(_svr_sums(points, epsilon), "p int, i int, v double").groupBy("p", "i").agg(F.sum("v").alias("v"))
        got = np.zeros((len(grid), 1 + k + k * k))
        for r in sums.collect():  # (k + 2)^2 numbers a grid point
            got[r.p, r.i] = r.v / count[r.p]
        for p in todo:
            s, ridge = state[p], np.full(k, 1.0 / (grid[p][1] * count[p]))
            ridge[0] = 0.0
            value = got[p, 0] + (ridge * s["w"] ** 2).sum() / 2
            if s["step"] is not None and value > s["best"][1] + 1e-12 * abs(s["best"][1]) and np.abs(s["step"]).max() > 1e-14:
                s["step"] = s["step"] / 2
                s["w"] = s["best"][0] + s["step"]
                continue
            grad = got[p, 1:1 + k] + ridge * s["w"]
            norm = float(np.abs(grad).max())
            if norm <= tol or (s["step"] is not None and np.abs(s["step"]).max() <= 1e-14):
                if s["stage"] == len(widths) - 1:
                    out[p] = (s["w"], float(value), norm)
                else:
                    s.update(stage=s["stage"] + 1, step=None)
                continue
            hess = got[p, 1 + k:].reshape(k, k) + np.diag(ridge)
            hess[np.diag_indices(k)] += 1e-9 + 1e-3 * norm
            s["best"] = (s["w"], value)
            s["step"] = -np.linalg.solve(hess, grad)
            s["w"] = s["w"] + s["step"]
    raise RuntimeError("support vector regression did not converge")


# ---------------------------------------------------------------- search

#: Numbers of a partition of the rows that are fitted one by one: 8 MB.
FIT_CELLS = 1 << 20


def _few_parts(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than ``FIT_CELLS`` numbers of its ``features`` each ask for."""
    first = df.select("features").first()
    cells = df.count() * len(first["features"]) if first and first["features"] else 1
    return df.coalesce(-(-cells // FIT_CELLS))


def model_search(train: DataFrame, test: DataFrame, zoo: dict, score, k: int = 5, fold_col: str = "fold",
                 threads: int = 4) -> list[tuple]:
    """k-fold search over every point of the grids in ``zoo``, refit of the best point, and
    scores on train and held-out rows.

    Rows (model, kind, grid_id, params, fold, score): kind ``fold`` per grid point and fold, ``mean``
    per grid point, ``train`` and ``test`` for the best point (highest mean, first on ties).
    ``params`` lists name=value sorted by name.  ``score(model, rows)`` is larger for better
    models.  The fits are independent Spark jobs run by a few driver threads, over partitions that are
    worth a task: a fit may pass its rows many times."""
    from multiprocessing.pool import ThreadPool

    train, test = _few_parts(cut_lineage(train)), _few_parts(cut_lineage(test))
    parts = [(train.where(F.col(fold_col) != f), train.where(F.col(fold_col) == f)) for f in range(k)]
    jobs = [(name, g, f) for name, (_, grid) in zoo.items() for g in range(len(grid)) for f in range(k)]

    def one(job):
        name, g, f = job
        est, grid = zoo[name]
        return float(score(est.copy(grid[g]).fit(parts[f][0]), parts[f][1]))

    def text(point):
        return ", ".join(f"{n}={v}" for n, v in sorted((p.name, v) for p, v in point.items()))

    pool = ThreadPool(threads)
    try:
        got = dict(zip(jobs, pool.map(one, jobs, chunksize=1), strict=True))
        means = {name: [float(np.mean([got[name, g, f] for f in range(k)])) for g in range(len(grid))]
                 for name, (_, grid) in zoo.items()}

        def refit(name):
            est, grid = zoo[name]
            best = int(np.argmax(means[name]))
            model = est.copy(grid[best]).fit(train)
            return name, best, float(score(model, train)), float(score(model, test))
        finals = pool.map(refit, list(zoo), chunksize=1)
    finally:
        pool.close()
    rows = [(name, "fold", g, text(zoo[name][1][g]), f, v) for (name, g, f), v in got.items()]
    rows += [(name, "mean", g, text(zoo[name][1][g]), None, v) for name, ms in means.items() for g, v in enumerate(ms)]
    for name, best, a, b in finals:
        rows += [(name, "train", best, text(zoo[name][1][best]), None, a), (name, "test", best, text(zoo[name][1][best]), None, b)]
    return rows


# ---------------------------------------------------------------- AdaBoost

def adaboost_r2(df: DataFrame, feats: list[str], label: str, rounds: int = 10, depth: int = 3,
                lr: float = 1.0) -> list[tuple[object, float, float]]:
    """AdaBoost.R2 (linear loss): trees fitted with a weight column; the weight
    update is a column expression, the rows are stored between rounds and those of the round
    before removed, so that two copies stand at most.
    Returns (tree, estimator weight, weighted loss) per round; boosting ends early
    when a tree is perfect or no better than chance."""
    d = stored(df.select(*feats, label).withColumn("_w", F.lit(1.0)))
    out = []
    for m in range(rounds):
        x = assemble(d, feats)
        model = DecisionTreeRegressor(labelCol=label, weightCol="_w", maxDepth=depth, seed=m).fit(x)
        p = model.transform(x).withColumn("_err", F.abs(F.col("prediction") - F.col(label)))
        sw = p.agg(F.sum("_w"), F.sum(F.col("_w") * F.col("_err")), F.max("_err")).first()
        mx = sw[2] or 0.0
        p = p.withColumn("_l", F.col("_err") / F.lit(mx) if mx > 0 else F.lit(0.0))
        avg_loss = (sw[1] / mx / sw[0]) if sw[0] and mx > 0 else 0.0
        if avg_loss <= 0:
            out.append((model, 1.0, 0.0))
            break
        if avg_loss >= 0.5:
            if not out:
                out.append((model, 1.0, float(avg_loss)))
            break
        beta = avg_loss / (1 - avg_loss)
        out.append((model, float(lr * math.log(1 / beta)), float(avg_loss)))
        if m + 1 < rounds:
            d = _next(d, p.select(*feats, label, (F.col("_w") * F.pow(F.lit(beta), (1 - F.col("_l")) * lr)).alias("_w")))
    discard(d)
    return out


def _next(old: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, made from ``old``, in its place."""
    new = stored(rows)
    discard(old)
    return new


def _each_prediction(df: DataFrame, fitted: list) -> DataFrame:
    """``df`` with _p0, _p1, ...: the prediction of each fitted tree."""
    for i, (model, *_) in enumerate(fitted):
        df = model.copy({model.predictionCol: f"_p{i}"}).transform(df.drop("rawPrediction", "probability"))
    return df


def weighted_median(df: DataFrame, fitted: list, out: str = "prediction") -> DataFrame:
    """AdaBoost.R2 prediction: the weighted median of the trees' predictions."""
    d = _each_prediction(df, fitted)
    votes = F.array_sort(F.array(*[F.struct(F.col(f"_p{i}").alias("v"), F.lit(w).alias("w"))
                                   for i, (_, w, _) in enumerate(fitted)]))
    half = sum(w for _, w, _ in fitted) / 2
    found = F.aggregate(votes, F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("v")),
                        lambda acc, x: F.struct((acc["s"] + x["w"]).alias("s"), F.coalesce(
                            acc["v"], F.when(acc["s"] + x["w"] >= half - 1e-12, x["v"])).alias("v")), lambda acc: acc["v"])
    return d.withColumn(out, found).drop(*[f"_p{i}" for i in range(len(fitted))])


def adaboost_samme(df: DataFrame, feats: list[str], label: str, n_classes: int, rounds: int = 10,
                   depth: int = 1) -> list[tuple[object, float, float]]:
    """SAMME: stumps with a weight column; alpha = ln((1-err)/err) + ln(K-1).  Returns
    (tree, alpha, weighted error) per round, with the same early end as above."""
    d = stored(df.select(*feats, label).withColumn("_w", F.lit(1.0)))
    out = []
    for m in range(rounds):
        x = assemble(d, feats)
        model = DecisionTreeClassifier(labelCol=label, weightCol="_w", maxDepth=depth, seed=m).fit(x)
        p = model.transform(x).withColumn("_miss", (F.col("prediction") != F.col(label)).cast("double"))
        s = p.agg(F.sum("_w"), F.sum(F.col("_w") * F.col("_miss"))).first()
        err = (s[1] / s[0]) if s[0] else 0.0
        if err <= 0:
            out.append((model, 1.0, 0.0))
            break
        if err >= 1 - 1.0 / n_classes:
            if not out:
                out.append((model, 1.0, float(err)))
            break
        alpha = math.log((1 - err) / err) + math.log(n_classes - 1)
        out.append((model, float(alpha), float(err)))
        if m + 1 < rounds:
            d = _next(d, p.select(*feats, label, (F.col("_w") * F.exp(F.lit(alpha) * F.col("_miss"))).alias("_w")))
    discard(d)
    return out


def weighted_vote(df: DataFrame, fitted: list, n_classes: int, out: str = "prediction") -> DataFrame:
    """SAMME prediction: the class with the largest sum of alphas (the smallest class on ties)."""
    d = _each_prediction(df, fitted)
    votes = [sum((F.when(F.col(f"_p{i}") == c, a).otherwise(0.0) for i, (_, a, _) in enumerate(fitted)), F.lit(0.0))
             for c in range(n_classes)]
    best = F.array_position(F.array(*votes), F.array_max(F.array(*votes)))
    return d.withColumn(out, (best - 1).cast("double")).drop(*[f"_p{i}" for i in range(len(fitted))])


# ---------------------------------------------------------------- kernels

def random_fourier(df: DataFrame, feats: list[str], n_components: int = 50, gamma: float = 1.0,
                   seed: int = 0, out: str = "rff") -> DataFrame:
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi)  (Rahimi & Recht 2007).
    W and b are D x (k+1) numbers, fixed on the driver and inlined."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, len(feats)))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    comps = [F.lit(scale) * F.cos(sum((F.col(c) * float(W[j, i]) for i, c in enumerate(feats)), F.lit(float(b[j]))))
             for j in range(n_components)]
    return df.withColumn(out, array_to_vector(F.array(*comps)))


def kernel_features(kernel: str, n_in: int, gamma: float, n_components: int = 50, seed: int = 0):
    """numpy map (rows x n_in) -> explicit features of a kernel, with a constant: ``rbf`` by random
    Fourier features (Rahimi & Recht 2007), ``poly`` exactly, all monomials up to degree 2 scaled as
    in (gamma x.y + 1)^2, ``linear`` the inputs."""
    if kernel == "rbf":
        rng = np.random.default_rng(seed)
        w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_in, n_components))
        b = rng.uniform(0, 2 * math.pi, size=n_components)
        return lambda x: np.column_stack([np.ones(len(x)), math.sqrt(2.0 / n_components) * np.cos(x @ w + b)])
    if kernel == "poly":
        pairs = [(i, j) for i in range(n_in) for j in range(i, n_in)]
        return lambda x: np.column_stack([np.ones(len(x)), math.sqrt(2 * gamma) * x] + [
            gamma * (1.0 if i == j else math.sqrt(2.0)) * x[:, i] * x[:, j] for i, j in pairs])
    return lambda x: np.column_stack([np.ones(len(x)), x])


def kernel_gram(df: DataFrame, feats: list[str], label: str, part_col: str, kernels: list[tuple[str, float]]) -> dict:
    """(kernel, part) -> {n, sy, syy, xx, xy} over the explicit features of each kernel: every batch
    is multiplied out in its task and only sums are shuffled; the result has (features + 1)^2
    numbers per kernel and part."""
    from kestrel.session import ship_package
    ship_package(df.sparkSession)
    maps = [kernel_features(k, len(feats), g) for k, g in kernels]

    def run(batches):
        for b in batches:
            x, y, part = b[feats].to_numpy(np.float64), b[label].to_numpy(np.float64), b[part_col].to_numpy()
            for p in np.unique(part):
                xp, yp = x[part == p], y[part == p]
                for i, phi in enumerate(maps):
                    z = phi(xp)
                    v = np.concatenate([[len(yp), yp.sum(), yp @ yp], z.T @ yp, (z.T @ z).ravel()])
                    yield pd.DataFrame({"kernel": i, "part": int(p), "i": np.arange(len(v)), "v": v})
    sums = df.select(*feats, label, part_col).dropna().mapInPandas(run, "kernel int, part int, i int, v double")
    got: dict = {}
    for r in sums.groupBy("kernel", "part", "i").agg(F.sum("v").alias("v")).collect():
        got.setdefault((r.kernel, r.part), {})[r.i] = r.v
    out = {}
    for key, cells in got.items():
        v = np.array([cells[i] for i in range(len(cells))])
        k = round((-1 + math.sqrt(1 + 4 * (len(v) - 3))) / 2)
        out[key] = dict(n=v[0], sy=v[1], syy=v[2], xy=v[3:3 + k], xx=v[3 + k:].reshape(k, k), xs=np.zeros(k))
    return out


# ---------------------------------------------------------------- Gaussian NB / QDA

def gaussian_nb(df: DataFrame, feats: list[str], label: str, var_smoothing: float = 1e-9) -> DataFrame:
    """Per-class prior, mean, population variance (+ smoothing) -> class with the
    highest log joint density.  Moments: one groupBy; scoring: an expression."""
    mom = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m_{c}") for c in feats],
                                *[F.var_pop(c).alias(f"_v_{c}") for c in feats]).collect()
    total = sum(r["_n"] for r in mom)
    eps = var_smoothing * max(max((r[f"_v_{c}"] or 0.0) for r in mom) for c in feats)
    scores = []
    for r in mom:
        s = F.lit(math.log(r["_n"] / total))
        for c in feats:
            v = (r[f"_v_{c}"] or 0.0) + eps
            s = s - F.lit(0.5 * math.log(2 * math.pi * v)) - (F.col(c) - F.lit(r[f"_m_{c}"])) ** 2 / F.lit(2 * v)
        scores.append(F.struct(s.alias("s"), F.lit(r[label]).alias("k")))
    best = F.reduce(F.array(*scores[1:]), scores[0], lambda acc, x: F.when(x["s"] > acc["s"], x).otherwise(acc))
    return df.withColumn("prediction", best["k"])


def qda(df: DataFrame, feats: list[str], label: str) -> DataFrame:
    """Quadratic discriminant: per-class prior, mean and covariance (sample, ddof 1) from one aggregate of
    outer products, a Cholesky factor per class, scores by its inverse as column expressions.

    A class whose covariance is singular (or has one row) gets 1e-9 of its mean variance, ten times more
    until a factor exists, on the diagonal; without any variance, 1e-9.  Rows with a null
    feature have a null prediction, and class labels that are null are left out."""
    from kestrel.operators.linear import gram_sums, unpack_gram
    k = len(feats)
    centre = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in feats]).first()  # against cancellation
    moved = df.dropna(subset=[*feats, label]).select(F.col(label).alias("_y"), F.lit(0.0).alias("_t"), *[
        (F.col(c) - F.lit(float(m))).alias(f"_x{i}") for i, (c, m) in enumerate(zip(feats, centre))])
    sums = gram_sums(moved, ["_y"], [f"_x{i}" for i in range(k)], "_t").collect()
    total = sum(r["n"] for r in sums)
    scores = []
    for r in sorted(sums, key=lambda r: r["_y"]):
        g = unpack_gram(r, k)
        mean = g["xs"] / g["n"]
        cov = (g["xx"] - np.outer(mean, mean) * g["n"]) / max(g["n"] - 1, 1)
        more, unit = 0.0, float(np.trace(cov)) / k or 1.0
        while True:
            try:
                factor = np.linalg.cholesky(cov + more * unit * np.eye(k))
                if np.diag(factor).min() > 1e-8 * math.sqrt(unit):
                    break
            except np.linalg.LinAlgError:
                pass
            more = more * 10 or 1e-9
        inverse = np.linalg.inv(factor)
        x = [F.col(c) - F.lit(float(centre[i] + mean[i])) for i, c in enumerate(feats)]
        z = [sum((x[i] * float(inverse[j, i]) for i in range(j + 1)), F.lit(0.0)) for j in range(k)]
        s = F.lit(math.log(g["n"] / total) - float(np.log(np.diag(factor)).sum())) - 0.5 * sum((v * v for v in z), F.lit(0.0))
        scores.append(F.struct(s.alias("s"), F.lit(r["_y"]).alias("k")))
    if not scores:
        return df.withColumn("prediction", F.lit(None).cast(df.schema[label].dataType))
    best = F.reduce(F.array(*scores[1:]), scores[0], lambda acc, x: F.when(x["s"] > acc["s"], x).otherwise(acc))
    known = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in feats])
    return df.withColumn("prediction", F.when(known, best["k"]))


# ---------------------------------------------------------------- evaluator

class MetricEvaluator(Evaluator):
    """Custom scorer: r2 (regression) or exact AUC (binary) from kestrel metrics."""

    def __init__(self, metric: str = "r2", label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.metric, self.label, self.prediction = metric, label, prediction

    def _evaluate(self, dataset):
        from kestrel.operators import metrics as mt
        if self.metric == "r2":
            return mt.regression_metrics(dataset, self.label, self.prediction).first()["r2"]
        score = dataset.withColumn("_s", vector_to_array("probability")[1])
        return mt.auc(score, self.label, "_s").first()["auc"]

    def isLargerBetter(self):
        return True


# The text pipeline's grid.
TEXT_FEATURES, TEXT_PENALTIES = [10, 100, 1000], [0.1, 0.01]


def text_pipeline(label: str = "label"):
    from pyspark.ml.feature import HashingTF, Tokenizer
    tok = Tokenizer(inputCol="text", outputCol="words")
    tf = HashingTF(inputCol="words", outputCol="features")
    lr = LogisticRegression(maxIter=10, labelCol=label)
    grid = ParamGridBuilder().addGrid(tf.numFeatures, TEXT_FEATURES).addGrid(lr.regParam, TEXT_PENALTIES).build()
    return Pipeline(stages=[tok, tf, lr]), grid


def text_search(docs: DataFrame, evaluator: Evaluator, fold_col: str, k: int, label: str = "label"):
    """Search of ``text_pipeline``: (its grid, mean score of each point, pipeline model of the best).

    Words are split and counted once, for every number of features, and the counts stored; the fits of the
    folds and points read those."""
    from pyspark.ml import PipelineModel
    pipe, grid = text_pipeline(label)
    tok, tf, lr = pipe.getStages()
    counted = tok.transform(docs)
    for n in TEXT_FEATURES:
        counted = tf.copy({tf.numFeatures: n, tf.outputCol: f"_tf{n}"}).transform(counted)
    counted = stored(counted.select(label, fold_col, *[f"_tf{n}" for n in TEXT_FEATURES]))
    points = [{lr.featuresCol: f"_tf{p[tf.numFeatures]}", lr.regParam: p[lr.regParam]} for p in grid]
    found = cross_validate(lr, points, counted, evaluator, fold_col=fold_col, k=k)
    best = int(np.argmax(found.avgMetrics) if evaluator.isLargerBetter() else np.argmin(found.avgMetrics))
    model = PipelineModel([tok, tf.copy({tf.numFeatures: grid[best][tf.numFeatures]}), found.bestModel.setFeaturesCol(tf.getOutputCol())])
    return grid, found.avgMetrics, model
