"""Calibration, support vector classification, discriminants, paths and searches per data set, against plain numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kestrel.operators import calibration as cal, linear, macro as mc, models as md, per_group as pg, svm


def test_platt_is_a_plain_newton_fit(spark):
    r = np.random.default_rng(2)
    m = r.normal(3, 40, 3000)
    y = (r.random(3000) < 1 / (1 + np.exp(-(m - 5) / 20))).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"m": m, "y": y}))
    a, b = cal.platt(df, "m", "y")
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.zeros(2)
    x = np.column_stack([m / 40, np.ones(len(m))])
    for _ in range(50):
        p = 1 / (1 + np.exp(x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (t - p))
    assert math.isclose(a, w[0] / 40, rel_tol=1e-6) and math.isclose(b, w[1], rel_tol=1e-6, abs_tol=1e-8)
    p1 = df.select("y", cal.sigmoid(F.col("m"), a, b).alias("p")).toPandas()
    assert ((p1.y - p1.p) ** 2).mean() < 0.65 * y.var()
    assert cal.platt(df.limit(0), "m", "y") == (0.0, 0.0)
    a, b = cal.platt(df.where("y = 1"), "m", "y")  # one class: certain, but finite
    assert all(map(math.isfinite, (a, b))) and 1 / (1 + math.exp(a * 3 + b)) > 0.99
    a, b = cal.platt(df.withColumn("m", F.lit(1.0)), "m", "y")
    assert math.isclose(1 / (1 + math.exp(a + b)), t.mean(), rel_tol=1e-6)


def classes(n=600, seed=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] + 0.4 * r.normal(size=n) > 0.3).astype(float)
    return pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y, "fold": np.arange(n) % 3})


def test_svm_folds_and_optimum(spark):
    pdf = classes()
    df = spark.createDataFrame(pdf).repartition(4)
    fits = svm.Svm(df, ["a", "b", "c"], "y", {"linear": svm.linear}, [0.025, 1.0], "fold", [-1, 0, 1, 2])
    assert max(fits.gradient.values()) <= 1e-6

    def objective(w, rows, c):
        z, s = np.column_stack([np.ones(len(rows)), rows[["a", "b", "c"]]]), 2 * rows["y"].to_numpy() - 1
        return (w[1:] ** 2).sum() / (2 * c * len(rows)) + (np.maximum(1 - s * (z @ w), 0) ** 2).mean()
    rng = np.random.default_rng(0)
    for (_, c, held), w in fits.weights.items():
        rows = pdf[pdf["fold"] != held]
        best = objective(w, rows, c)
        assert all(objective(w + 1e-2 * rng.normal(size=4), rows, c) > best for _ in range(50))
    m = fits.margins(df, "linear", 1.0, "fold").toPandas()
    for f in range(3):
        own = m[m["fold"] == f]
        w = fits.weights["linear", 1.0, f]
        assert np.allclose(own["margin"], w[0] + own[["a", "b", "c"]].to_numpy() @ w[1:])
    gone = fits.margins(df.withColumn("a", F.when(F.col("b") > 0, F.col("a"))), "linear", 1.0)
    assert gone.where("b <= 0 AND margin IS NOT NULL").count() == 0


def test_feature_maps_approximate_their_kernels(spark):
    x = classes(300)[["a", "b", "c"]].to_numpy()
    exact = svm.rbf(x, x, 0.3)
    errors = [np.abs(f(x) @ f(x).T - exact).mean() for f in (svm.nystroem(x, 0.3, m) for m in (10, 60, 300))]
    assert errors[0] > errors[1] > errors[2] and errors[1] < 0.01 and errors[2] < 1e-6
    exact = (0.3 * x @ x.T + 1) ** 3
    sketches = [svm.tensor_sketch(3, 0.3, 3, 256, s)(x) for s in range(60)]
    mean = sum(z @ z.T for z in sketches) / len(sketches)
    assert np.abs(mean - exact).mean() < 0.1 * np.abs(exact).mean()  # unbiased
    df = spark.createDataFrame(classes(500))
    a, b = (svm.bounded_sample(df.repartition(k), ["a", "b"], 50) for k in (2, 7))
    assert a.shape == (50, 2) and (a == b).all()


def test_qda_of_many_features_and_singular_classes(spark):
    r = np.random.default_rng(5)
    x = np.concatenate([r.multivariate_normal(m, c, 200) for m, c in (
        ([1e6, 0, 0], [[2, 1, 0], [1, 2, .5], [0, .5, 1]]), ([1e6 + 2, 1, -1], np.eye(3) * 3))])
    y = np.repeat([0.0, 1.0], 200)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    score = []
    for k in (0, 1):
        own = x[y == k]
        d, s = x - own.mean(0), np.cov(own.T)
        score.append(math.log(0.5) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (d @ np.linalg.inv(s) * d).sum(1))
    got = md.qda(df, ["a", "b", "c"], "y").toPandas()
    want = dict(zip(map(tuple, x), np.argmax(score, axis=0)))
    assert all(want[a, b, c] == p for a, b, c, _, p in got.itertuples(index=False))
    flat = md.qda(df.withColumn("c", F.when(F.col("y") == 1, F.lit(2.0)).otherwise(F.col("c"))).withColumn("d", F.col("a") * 2),
                  ["a", "c", "d"], "y")  # a constant in one class, a dependent feature in both
    assert flat.where("prediction = y").count() > 380
    nulls = md.qda(df.withColumn("b", F.when(F.col("a") > 1e6, F.col("b"))), ["a", "b"], "y")
    assert nulls.where("b IS NULL AND prediction IS NOT NULL").count() == 0
    assert md.qda(df.limit(0), ["a"], "y").count() == 0


def test_var_errors_and_t_values(spark):
    r = np.random.default_rng(9)
    v = np.cumsum(r.normal(size=(60, 2)), axis=0) * 0.1 + r.normal(size=(60, 2))
    df = spark.createDataFrame(pd.DataFrame({"i": range(60), "u": v[:, 0], "w": v[:, 1]}))
    fit = mc.var_fit(df, 2, ["u", "w"])
    x = np.column_stack([np.ones(58), v[1:-1], v[:-2]])
    b, *_ = np.linalg.lstsq(x, v[2:], rcond=None)
    e = v[2:] - x @ b
    s = e.T @ e / (58 - 5)
    want = np.sqrt(np.outer(np.diag(np.linalg.inv(x.T @ x)), np.diag(s)))
    assert np.allclose(fit["coef"], b) and np.allclose(fit["stderr"], want) and np.allclose(fit["t"], b / want)
    assert np.isnan(mc.var_fit(df.where("i < 6"), 2, ["u", "w"])["stderr"]).all()


@pytest.mark.parametrize("seed", range(6))
def test_least_angle_path(seed):
    """Slopes at any penalty equal coordinate descent's; knots are where slopes start or end."""
    r = np.random.default_rng(seed)
    n, k = 80, 6
    x = r.normal(size=(n, k)) @ (np.eye(k) + 0.8 * r.normal(size=(k, k))) + 3
    y = x @ (r.normal(size=k) * (r.random(k) < 0.6)) + r.normal(size=n) - 2
    if seed == 4:
        x[:, 3] = x[:, 1] * 2  # dependent
    if seed == 5:
        x[:, 2] = 7.0  # constant
    g = dict(n=n, sy=y.sum(), syy=y @ y, xs=x.sum(0), xy=x.T @ y, xx=x.T @ x)
    alphas, slopes = path = linear.lars_path(g)
    assert (np.diff(alphas) < 0).all() and alphas[-1] == 0 and not slopes[0].any()

    for a in [*alphas[:-1], *(alphas[:-1] + np.diff(alphas) * 0.3), 1e-4, 1e-3, 0.01, 0.1, 1.0]:
        w = linear.at_alpha(g, path, a)
        rest = y - w[0] - x @ w[1:]
        c = (x - x.mean(0)).T @ rest / n  # optimal: a times the slope's sign, at most a where it is zero
        assert abs(rest.mean()) < 1e-9 and (np.abs(c) <= a + 1e-8).all()
        assert np.allclose(c[w[1:] != 0], a * np.sign(w[1:][w[1:] != 0]), atol=1e-8)
        if seed < 4:
            assert np.allclose(w, md.elastic_net(g, a, 1.0, tol=1e-13, sweeps=200_000), atol=1e-7)


def test_lasso_and_ridge_per_data_set(spark):
    r = np.random.default_rng(4)
    rows = []
    for g in range(7):
        n = [400, 3, 60, 1, 45, 200, 30][g]
        x = r.normal(size=(n, 2)) + g
        y = 2 * x[:, 0] + r.normal(size=n) * (0 if g == 4 else 1)
        if g == 6:
            y[:] = 5.0
        rows += [(g, *map(float, p), float(v), i % 4 - (i % 9 == 8) * (i % 4 + 1)) for i, (p, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "g long, a double, b double, y double, fold int").repartition(3)
    grids = {"ridge": [0.01, 10.0], "lasso": [0.001, 0.5]}
    got = {(x.g, x.model): x for x in pg.search(df, "g", ["a", "b"], "y", "fold", 4, grids).collect()}
    assert len(got) == 14
    pdf = pd.DataFrame(rows, columns=["g", "a", "b", "y", "fold"])

    def sums(p):
        x, y = p[["a", "b"]].to_numpy(), p["y"].to_numpy()
        return dict(n=len(p), sy=y.sum(), syy=y @ y, xs=x.sum(0), xy=x.T @ y, xx=x.T @ x)

    def fit(model, p, a):
        if model == "lasso":
            return md.elastic_net(sums(p), a, 1.0)
        x = p[["a", "b"]] - p[["a", "b"]].mean()
        w = np.linalg.solve(x.T @ x + a * np.eye(2), x.T @ (p["y"] - p["y"].mean()))
        return np.array([p["y"].mean() - w @ p[["a", "b"]].mean(), *w])
    for g in (0, 2, 5):
        tr, te = pdf[(pdf.g == g) & (pdf.fold >= 0)], pdf[(pdf.g == g) & (pdf.fold < 0)]
        for model, alphas in grids.items():
            cv = [np.mean([linear.r2_with_intercept(sums(tr[tr.fold == f]), fit(model, tr[tr.fold != f], a)) for f in range(4)])
                  for a in alphas]
            x, best = got[g, model], int(np.argmax(cv))
            assert x.alpha == alphas[best] and math.isclose(x.cv_r2, cv[best], rel_tol=1e-6)
            w = fit(model, tr, x.alpha)
            assert np.allclose([x.intercept, *x.coef], w, rtol=1e-6, atol=1e-8)
            assert math.isclose(x.test_r2, linear.r2_with_intercept(sums(te), w), rel_tol=1e-6)
            assert (x.n_train, x.n_test) == (len(tr), len(te))
    assert got[4, "ridge"].test_r2 > 0.999 and got[6, "ridge"].train_r2 is None and got[3, "lasso"].cv_r2 is None
