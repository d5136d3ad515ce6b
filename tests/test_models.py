"""Fits against closed forms, library fits and optimality conditions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from kestrel.operators import encode, linear, metrics as mt, models as md
from kestrel.sources import files as fl

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 3))
    y = x @ [2.0, -1.0, 0.0] + 0.5 + r.normal(scale=0.7, size=400)
    y /= y.std(ddof=1)  # the library divides its l2 penalty by the label's deviation
    return spark.createDataFrame(pd.DataFrame(x, columns=NAMES).assign(y=y, fold=np.arange(400) % 3))


@pytest.mark.parametrize("alpha, l1", [(0.01, 0.0), (0.2, 1.0), (0.5, 0.5), (5.0, 1.0)])
def test_elastic_net_matches_the_library(spark, rows, alpha, l1):
    g = linear.unpack_gram(linear.gram_sums(rows, [], NAMES, "y").first(), 3)
    w = md.elastic_net(g, alpha, l1)
    lib = LinearRegression(labelCol="y", regParam=alpha, elasticNetParam=l1, standardization=False, maxIter=500,
                           tol=1e-12).fit(md.assemble(rows, NAMES))
    assert np.allclose(w, [lib.intercept, *lib.coefficients], atol=1e-3)
    if l1 == 1.0 and alpha == 5.0:
        assert (w[1:] == 0).all()
    r2 = mt.regression_metrics(lib.transform(md.assemble(rows, NAMES)), "y", "prediction").first()["r2"]
    assert math.isclose(linear.r2_with_intercept(g, w), r2, abs_tol=1e-3)


def test_svr_meets_its_optimality_conditions(rows):
    grid = [(loss, c) for loss in ("epsilon_insensitive", "squared_epsilon_insensitive") for c in (1e-4, 1.0)]
    eps = 0.1
    fits = md.svr_fit(rows, NAMES, "y", grid, epsilon=eps)
    data = rows.toPandas()
    x, y = data[NAMES].to_numpy(), data["y"].to_numpy()
    n = len(y)

    def value(loss, c, w):
        h = np.maximum(np.abs(x @ w[1:] + w[0] - y) - eps, 0)
        return (w[1:] ** 2).sum() / (2 * c * n) + (h if loss == "epsilon_insensitive" else h * h).mean()
    r = np.random.default_rng(1)
    for (loss, c), (w, _, norm) in zip(grid, fits):
        assert norm <= 1e-6
        best = value(loss, c, w)
        for scale in (1e-1, 1e-2, 1e-3):
            for _ in range(50):  # no nearby point is better by more than the rounding of the loss
                assert value(loss, c, w + r.normal(scale=scale, size=4)) >= best - 2e-4
        if loss == "epsilon_insensitive":  # as many residuals above as below the tube
            e = y - x @ w[1:] - w[0]
            assert abs((e > eps + 1e-3).sum() - (e < -eps - 1e-3).sum()) <= 4


def test_knn_is_exact_and_its_broadcast_bounded(spark):
    r = np.random.default_rng(3)
    pts = [(i, [float(v) for v in r.integers(0, 4, 3)], int(r.integers(0, 3))) for i in range(90)]
    df = spark.createDataFrame(pts, "id long, f array<double>, y int")
    train, test = df.where("id < 60"), df.where("id >= 60")
    got = {(x.id, x.k): x.pred for x in md.knn_votes(train, test, [1, 4], "id", "f", "y").collect()}
    for i, f, _ in pts[60:]:
        near = sorted(pts[:60], key=lambda p: (sum((a - b) ** 2 for a, b in zip(p[1], f)), p[0]))
        for k in (1, 4):
            votes = [p[2] for p in near[:k]]
            assert got[i, k] == min(set(votes), key=lambda c: (-votes.count(c), c))
    with pytest.raises(ValueError):
        md.knn_votes(train, test, [1], "id", "f", "y", max_train=59)


def test_knn_merges_blocks_and_has_no_bound_of_its_own(spark):
    import inspect

    assert inspect.signature(md.knn_votes).parameters["max_train"].default is None
    r = np.random.default_rng(4)
    pts = [(i, [float(v) for v in r.integers(0, 3, 3)], int(r.integers(0, 3))) for i in range(700)]
    df = spark.createDataFrame(pts, "id long, f array<double>, y int")
    train, test = df.where("id < 100"), df.where("id >= 100")
    got = [(x.id, x.k, x.pred) for x in md.knn_votes(train, test.union(test.where("id < 110")), [3, 200], "id", "f", "y",
                                                     block_bytes=24 * 30).collect()]
    want = []
    for i, f, _ in pts[100:] + pts[100:110]:
        near = sorted(pts[:100], key=lambda p: (sum((a - b) ** 2 for a, b in zip(p[1], f)), p[0]))
        for k in (3, 200):
            votes = [p[2] for p in near[:k]]
            want.append((i, k, min(set(votes), key=lambda c: (-votes.count(c), c))))
    assert sorted(got) == sorted(want)
    assert md.knn_votes(train.limit(0), test, [3], "id", "f", "y").count() == 0
    assert md.knn_votes(train, test.limit(0), [3], "id", "f", "y").count() == 0


def test_search_visits_every_point_and_fold(rows):
    df = md.assemble(rows, NAMES).withColumnRenamed("y", "label").select("features", "label", "fold")
    train, test = df, df.where("fold = 0")
    lr = LinearRegression(labelCol="label", maxIter=10)
    zoo = {**md.regressor_zoo(), "linear": (lr, ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.3]).addGrid(
        lr.elasticNetParam, [0.0, 0.8]).build())}

    def r2(model, part):
        return mt.regression_metrics(model.transform(part), "label", "prediction").first()["r2"]
    got = md.model_search(train, test, zoo, r2, k=3)
    for name, (_, grid) in zoo.items():
        folds = {(g, f): s for m, kind, g, _, f, s in got if m == name and kind == "fold"}
        means = {g: s for m, kind, g, _, _, s in got if m == name and kind == "mean"}
        assert set(folds) == {(g, f) for g in range(len(grid)) for f in range(3)}
        assert all(math.isclose(means[g], np.mean([folds[g, f] for f in range(3)])) for g in means)
        best = next(g for m, kind, g, *_ in got if m == name and kind == "test")
        assert means[best] == max(means.values())
    data = rows.toPandas()  # the unpenalised point of fold 1 against least squares
    tr, te = data[data.fold != 1], data[data.fold == 1]
    design = np.column_stack([np.ones(len(tr)), tr[NAMES]])
    w = np.linalg.lstsq(design, tr["y"], rcond=None)[0]
    e = te["y"] - w[0] - te[NAMES] @ w[1:]
    want = 1 - (e ** 2).sum() / ((te["y"] - te["y"].mean()) ** 2).sum()
    plain = next(g for g, p in enumerate(zoo["linear"][1]) if all(v == 0.0 for v in p.values()))
    assert math.isclose(next(s for m, k, g, _, f, s in got if (m, k, g, f) == ("linear", "fold", plain, 1)), want, abs_tol=1e-6)
    assert all(", ".join(sorted(p.split(", "))) == p for *_, p, _, _ in got)
    sums = {r["fold"]: linear.unpack_gram(r, 3) for r in linear.gram_sums(rows, ["fold"], NAMES, "y").collect()}
    points = [("plain", lambda g: md.elastic_net(g, 0.0, 0.0)), ("none", lambda g: np.zeros(4))]
    own = md.gram_search([sums[f] for f in range(3)], sums[0], points, linear.r2_with_intercept)
    assert math.isclose(next(v for k, g, _, f, v in own if (k, g, f) == ("fold", 0, 1)), want, abs_tol=1e-6)
    assert [(k, g) for k, g, *_ in own[-2:]] == [("train", 0), ("test", 0)]


def test_boosted_trees_predict_better_than_one(spark, rows):
    fitted = md.adaboost_r2(rows, NAMES, "y", rounds=6, depth=2)
    feats = md.assemble(rows, NAMES)
    one = mt.regression_metrics(fitted[0][0].transform(feats), "y", "prediction").first()["r2"]
    many = mt.regression_metrics(md.weighted_median(feats, fitted), "y", "prediction").first()["r2"]
    assert len(fitted) > 2 and many > one
    cls = rows.withColumn("label", (F.col("y") > 0.5).cast("double"))
    fitted = md.adaboost_samme(cls, NAMES, "label", 2, rounds=8)
    feats = md.assemble(cls, NAMES)

    def acc(p):
        return p.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc(md.weighted_vote(feats, fitted, 2)) >= acc(fitted[0][0].transform(feats))


def test_class_count_is_a_property_of_the_problem(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (1, 2, 2), (1, 1, 1)], "b int, y int, p int")
    two = {r.b: r for r in mt.classification_metrics(df, "y", "p", ["b"]).collect()}
    three = {r.b: r for r in mt.classification_metrics(df, "y", "p", ["b"], n_classes=3).collect()}
    assert two[0].precision == 0.5 and two[0].recall == 1.0
    assert all(r.precision == r.recall == r.f1 == 0.0 for r in three.values()) and three[1].accuracy == 1.0


def test_curves_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert mt.auc(df, "y", "s").first()["auc"] == mt.AUC_UNDEFINED
    points = {(r.fpr, r.tpr) for r in mt.roc_points(df, "y", "s").collect()}
    assert points == {(0.0, 0.0), (0.0, 0.5), (0.0, 1.0)}


def test_files_per_key_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([("007", 1), ("12", 2), (None, 3)], "k string, v int")
    p = fl.write_per_key(df, "k", str(tmp_path / "k"), folders=4)
    assert sorted(map(tuple, fl.read_per_key(spark, p, df.schema, "k").collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert [r.v for r in fl.read_per_key(spark, p, df.schema, "k", "007", folders=4).collect()] == [1]


def test_a_damaged_copy_is_not_overwritten(spark, tmp_path):
    made = []

    def produce():
        made.append(1)
        return spark.range(3)
    path = str(tmp_path / "c")
    assert fl.cached_convert(spark, path, produce).count() == 3
    assert fl.cached_convert(spark, path, produce).count() == 3 and len(made) == 1
    for f in (tmp_path / "c").glob("part-*.parquet"):
        f.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        fl.cached_convert(spark, path, produce)
    assert len(made) == 1


def test_scaling_uses_the_train_rows(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 0), (9.0, 1)], "x double, test int")
    z = encode.zscore(df, ["x"], fit_on=df.where("test = 0")).collect()
    assert [r.x for r in z] == [-1.0, 1.0, 7.0]


def test_kernel_sums(spark, rows):
    """The polynomial features reproduce the kernel, and the sums equal numpy's."""
    x = rows.toPandas()
    phi = md.kernel_features("poly", 3, 0.5)
    z = phi(x[NAMES].to_numpy())
    k = (0.5 * x[NAMES].to_numpy() @ x[NAMES].to_numpy().T + 1) ** 2
    assert np.allclose(z @ z.T, k)
    got = md.kernel_gram(rows, NAMES, "y", "fold", [("poly", 0.5), ("rbf", 0.1)])
    for f in range(3):
        m = (x.fold == f).to_numpy()
        assert np.allclose(got[0, f]["xx"], z[m].T @ z[m]) and np.allclose(got[0, f]["xy"], z[m].T @ x.y.to_numpy()[m])
        assert got[1, f]["xx"].shape == (51, 51)


@pytest.mark.parametrize("query", ["tun_model_zoo", "tun_model_zoo_cls"])
def test_the_zoo_searches_its_parts_side_by_side(spark, monkeypatch, query):
    """The fits one by one run while the trees grow; the rows keep their order."""
    import threading

    from kestrel.plans import q_models
    from kestrel.plans.registry import QUERIES
    z = ["a_z", "b_z"]
    df = md.assemble(spark.range(60).select("id", (F.col("id") % 5).alias("fold"), F.sin("id").alias("a_z"), F.cos("id").alias("b_z"),
                                            (F.col("id") % 2).cast("double").alias("y"), F.sin(F.col("id") + 1).alias("label_z")), z)
    grown, seen = threading.Event(), []
    monkeypatch.setattr(q_models, "_zoo_parts", lambda *a: (df, df, z))

    def model_search(*a, **k):
        seen.append(grown.wait(60))
        return [("one by one", "mean", 0, "", None, 0.5)]

    def tree_search(*a, **k):
        grown.set()
        return [("mean", 0, "", None, 0.25)]
    monkeypatch.setattr(md, "model_search", model_search)
    monkeypatch.setattr(md, "tree_search", tree_search)
    names = [r.model for r in QUERIES[query](spark, "").collect()]
    assert seen == [True] and names[0] == "one by one" and names[-2:] == ["forest", "boosting"]


def test_fits_one_by_one_pass_few_partitions(spark, rows, monkeypatch):
    """The partitions follow the size of the rows, not the shuffle that made them, and hold every row."""
    df = md.assemble(rows, NAMES).select("features", "y", "fold").repartition(32)
    seen = []

    class Fit:
        def copy(self, point):
            return self

        def fit(self, part):
            seen.append((part.rdd.getNumPartitions(), part.count()))

    def search():
        seen.clear()
        md.model_search(df, df, {"x": (Fit(), [{}])}, lambda model, part: 0.0, k=3)
        return sorted(seen)
    assert search() == sorted([(1, 400 - n) for n in (134, 133, 133)] + [(1, 400)])
    monkeypatch.setattr(md, "FIT_CELLS", 300)
    assert search() == sorted([(4, 400 - n) for n in (134, 133, 133)] + [(4, 400)])


def test_svr_of_folds_is_that_of_the_rest(rows):
    grid = [("epsilon_insensitive", 0.1), ("squared_epsilon_insensitive", 1.0)]
    got = md.svr_fit(rows, NAMES, "y", grid, fold_col="fold", folds=(-1, 0, 1, 2))
    for f in (-1, 2):
        want = md.svr_fit(rows.where(F.col("fold") != f), NAMES, "y", grid)
        for g in range(2):
            assert np.allclose(got[4 * g + f + 1][0], want[g][0], atol=1e-4)
    sums = {r["fold"]: linear.unpack_gram(r, 3) for r in linear.gram_sums(rows, ["fold"], NAMES, "y").collect()}
    found = md.fold_rows([sums[f] for f in range(3)], sums[0], ["a", "b"], [w for w, *_ in got], linear.r2_with_intercept)
    means = [v for k, *_, v in found if k == "mean"]
    assert len(found) == 10 and found[-1][:3] == ("test", int(np.argmax(means)), "ab"[int(np.argmax(means))])
    assert math.isclose(next(v for k, g, _, f, v in found if (k, g, f) == ("fold", 1, 2)), linear.r2_with_intercept(sums[2], got[7][0]))


def test_neighbours_are_searched_over_folds(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(90, 2))
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(y=(x[:, 0] + r.normal(size=90) > 0).astype(float), fold=np.arange(90) % 3)
    train, test = spark.createDataFrame(pdf[:72]), spark.createDataFrame(pdf[72:])
    got = md.knn_search(train, test, ["a", "b"], "y", [3, 5], ["auto", "brute"], folds=3)

    def area(own, rest, k):
        near = ((own[["a", "b"]].to_numpy()[:, None] - rest[["a", "b"]].to_numpy()) ** 2).sum(axis=2).argsort(axis=1)[:, :k]
        p, y = rest["y"].to_numpy()[near].mean(axis=1), own["y"].to_numpy() > 0.5
        d = (p[y][:, None] - p[~y]).round(9)
        return ((d > 0) + 0.5 * (d == 0)).mean()
    points = [("auto", 3), ("brute", 3), ("auto", 5), ("brute", 5)]
    for g, (a, k) in enumerate(points):
        cv = [area(pdf[:72][pdf.fold[:72] == f], pdf[:72][pdf.fold[:72] != f], k) for f in range(3)]
        own = {f: v for kind, h, params, f, v in got if kind == "fold" and h == g and params == f"algorithm={a}, n_neighbors={k}"}
        assert [own[f] for f in range(3)] == pytest.approx(cv)
    best = got[-1][1]
    assert got[-1][0] == "test" and got[-1][-1] == pytest.approx(area(pdf[72:], pdf[:72], points[best][1]))


def test_zoo_grids_hold_the_reference_trees():
    from kestrel.plans import q_models as qm
    assert qm.FOREST_TREES == qm.BOOST_TREES == [10, 100, 1000] and qm.CLS_BOOST_TREES == [50, 100]
    assert len(qm.CLS_KNN_KS) * len(qm.CLS_KNN_ALGORITHMS) == 8
