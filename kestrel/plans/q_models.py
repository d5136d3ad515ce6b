"""Model, tuning and prediction queries (mostly rows-only checks)."""

from __future__ import annotations

import os
import uuid
from multiprocessing.pool import ThreadPool

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from kestrel.operators import linear, models as md, ticks as tk
from kestrel.operators.order import with_contiguous_folds
from kestrel.plans import q_ticks
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import with_views
from kestrel.session import checkpoint_dir, cut_lineage, discard, stored

FEATS = fx.REG_FEATURES
CLS_FEATS = ["label", "p_retailprice", "l_discount", "l_tax", "p_size"]


def _reg(spark, d):
    from kestrel.operators.sampling import split_by_key
    return md.assemble(split_by_key(fx.reg_table(spark, d), "l_orderkey", 0.75), FEATS)


def _cls(spark, d):
    from kestrel.operators.sampling import split_by_key
    r = fx.reg_table(spark, d).withColumn("y", (F.col("l_quantity") >= 25).cast("double"))
    return md.assemble(split_by_key(r, "l_orderkey", 0.75), CLS_FEATS)


def _split(df):
    return df.where("split = 'train'"), df.where("split = 'test'")


def _kept(df, feats, label):
    """Train and test rows of a fit that reads them many times: the columns it needs, joined and stored once."""
    return tuple(md.assemble(x, feats) for x in _split(stored(df.select(*dict.fromkeys([*feats, label]), "split"))))


def _reg_scores(spark, name, model, test, label="label"):
    p = model.transform(test)
    ev = RegressionEvaluator(labelCol=label)
    return spark.createDataFrame([(name, float(ev.setMetricName("rmse").evaluate(p)),
                                   float(ev.setMetricName("r2").evaluate(p)),
                                   float(ev.setMetricName("mae").evaluate(p)))],
                                 "model string, rmse double, r2 double, mae double")


def _cls_scores(spark, name, model, test, label="y", raw="rawPrediction"):
    p = model.transform(test)
    acc = p.agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, numBins=0).evaluate(p) \
        if raw in p.columns else float("nan")
    return spark.createDataFrame([(name, float(acc), float(auc))], "model string, accuracy double, auc double")


# ---------------------------------------------------------------- linear family

@register("mdl_linreg_one", sql=with_views("""
SELECT regr_slope(label, l_quantity) AS slope, regr_intercept(label, l_quantity) AS intercept,
       regr_r2(label, l_quantity) AS r2 FROM reg_table""", ["reg_table"]))
def q_linreg_one(spark, d):
    """The library's unpenalised fit on one feature."""
    df = md.assemble(fx.reg_table(spark, d), ["l_quantity"])
    m = LinearRegression(solver="normal").fit(df)
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept), float(m.summary.r2))],
                                 "slope double, intercept double, r2 double")


@register("mdl_linreg")
def q_linreg(spark, d):
    tr, te = _split(_reg(spark, d))
    m = LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8).fit(tr)
    return _reg_scores(spark, "linear_en", m, te)


@register("mdl_linreg_summary")
def q_linreg_summary(spark, d):
    tr, _ = _split(_reg(spark, d))
    m = LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8).fit(tr)
    return spark.createDataFrame(md.linreg_summary(m), "name string, value double")


@register("mdl_linreg_residuals")
def q_linreg_residuals(spark, d):
    """Residual of every train row of the same fit."""
    tr, _ = _split(_reg(spark, d))
    m = LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8).fit(tr)
    return m.transform(tr).select(*fx.REG_ORDER, (F.col("label") - F.col("prediction")).alias("residual"))


LASSO_ALPHAS = [1e-4, 1e-3, 0.01, 0.1, 1.0]


@register("mdl_lasso")
def q_lasso(spark, d):
    """Lasso over five penalties, read off the least-angle path of each fold and of all rows: 5-fold held-out r2,
    r2 on the test rows and the coefficients; and the knots of the path of all rows (null scores)."""
    z = [f"{c}_z" for c in FEATS]
    tr, te = _scaled(spark, d)
    folds = {r["fold"]: linear.unpack_gram(r, len(z)) for r in linear.gram_sums(tr, ["fold"], z, "label_z").collect()}
    test = linear.unpack_gram(linear.gram_sums(te, [], z, "label_z").first(), len(z))
    total = None
    for g in folds.values():
        total = g if total is None else linear.add(total, g)
    rest = [linear.add(total, g, -1.0) for g in folds.values()]
    paths, whole = [linear.lars_path(g) for g in rest], linear.lars_path(total)
    rows = []
    for a in LASSO_ALPHAS:
        cv = [linear.r2_with_intercept(g, linear.at_alpha(r, p, a)) for g, r, p in zip(folds.values(), rest, paths)]
        w = linear.at_alpha(total, whole, a)
        rows.append(("grid", a, float(sum(cv) / len(cv)), linear.r2_with_intercept(test, w), [float(x) for x in w]))
    rows += [("knot", float(a), None, None, [float(x) for x in linear.at_alpha(total, whole, a)]) for a in whole[0]]
    return spark.createDataFrame(rows, "kind string, alpha double, cv_r2 double, test_r2 double, coef array<double>")


# The penalty and regularisation grids of the two fits.
SGD_GRID = [(pen, l1, a) for pen, l1 in (("l2", 0.0), ("l1", 1.0), ("elasticnet", 0.15)) for a in (1e-6, 1e-4, 0.01, 1.0)]
SVR_GRID = [(loss, c) for loss in ("epsilon_insensitive", "squared_epsilon_insensitive") for c in (1e-6, 1e-4, 0.1, 1.0)]


def _scaled(spark, d):
    """Features and label scaled by the train split, with contiguous folds on it."""
    from kestrel.operators.encode import zscore
    from kestrel.operators.sampling import split_by_key
    r = split_by_key(fx.reg_table(spark, d), "l_orderkey", 0.75).select(*fx.REG_ORDER, "l_quantity", "l_discount",
                                                                       "l_tax", "p_size", "p_retailprice", "split")
    tr, te = _split(zscore(r, [*FEATS, "label"], fit_on=r.where("split = 'train'"), suffix="_z"))
    return with_contiguous_folds(tr, [], fx.REG_ORDER, 5), te


@register("mdl_sgd")
def q_sgd(spark, d):
    """Squared loss with l2, l1 or elastic-net penalty, 12 grid points: mean held-out r2 over 5
    folds, and of each point the refit's coefficients and its r2 on the test rows."""
    z = [f"{c}_z" for c in FEATS]
    tr, te = _scaled(spark, d)
    folds = {r["fold"]: linear.unpack_gram(r, len(z)) for r in linear.gram_sums(tr, ["fold"], z, "label_z").collect()}
    test = linear.unpack_gram(linear.gram_sums(te, [], z, "label_z").first(), len(z))
    total = None
    for g in folds.values():
        total = g if total is None else linear.add(total, g)
    rows = []
    for pen, l1, alpha in SGD_GRID:
        cv = [linear.r2_with_intercept(g, md.elastic_net(linear.add(total, g, -1.0), alpha, l1)) for g in folds.values()]
        w = md.elastic_net(total, alpha, l1)
        rows.append((pen, alpha, float(sum(cv) / len(cv)), linear.r2_with_intercept(test, w), [float(x) for x in w]))
    return spark.createDataFrame(rows, "penalty string, alpha double, cv_r2 double, test_r2 double, coef array<double>")


@register("mdl_svr_linear")
def q_svr(spark, d):
    """Linear support vector regression, 8 grid points: objective, gradient norm at the end
    and coefficients on the scaled train rows, r2 on the test rows."""
    z = [f"{c}_z" for c in FEATS]
    tr, te = _scaled(spark, d)
    fits = md.svr_fit(tr, z, "label_z", SVR_GRID)
    test = linear.unpack_gram(linear.gram_sums(te, [], z, "label_z").first(), len(z))
    rows = [(loss, c, value, norm, linear.r2_with_intercept(test, w), [float(x) for x in w])
            for (loss, c), (w, value, norm) in zip(SVR_GRID, fits)]
    return spark.createDataFrame(rows, "loss string, c double, objective double, gradient double, test_r2 double, "
                                       "coef array<double>")


@register("srt_params", sql=with_views(
    "SELECT dataset_id, ['alpha=' || CAST(best_alpha AS VARCHAR), 'feature=' || feature, 'folds=5'] AS params FROM res",
    ["dataset_family"], q_ticks.ridge_uni_sql("dataset_family", ["dataset_id"], ["x"], "y",
                                              "l_orderkey, l_linenumber, l_partkey, x, y")))
def q_srt_params(spark, d):
    """Best parameters of each data set's search, sorted by name."""
    rows = fx.dataset_family(spark, d)
    sums = linear.fold_sums_uni(rows, ["dataset_id"], ["x"], "y", ["l_orderkey", "l_linenumber", "l_partkey", "x", "y"])
    best = linear.ridge_uni_cv(sums, ["dataset_id"])
    params = F.create_map(F.lit("folds"), F.lit("5"), F.lit("feature"), F.col("feature"),
                          F.lit("alpha"), F.col("best_alpha").cast("string"))
    return best.select("dataset_id", F.transform(F.array_sort(F.map_entries(params)),
                                                 lambda e: F.concat(e["key"], F.lit("="), e["value"])).alias("params"))


KNN_KS = [3, 5, 8]


@register("jn_knn", sql=f"""
WITH f AS (SELECT b.vec_id, a.label, row_number() OVER (PARTITION BY b.vec_id ORDER BY
             list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (CAST(p[1] AS DOUBLE) - p[2]) ** 2)),
             a.vec_id) AS rk
           FROM embeddings a JOIN embeddings b ON a.vec_id % 4 <> 0 AND b.vec_id % 4 = 0),
     v AS (SELECT vec_id, k, label, count(*) AS n FROM f JOIN (SELECT unnest({KNN_KS}) AS k) ON rk <= k GROUP BY ALL)
SELECT vec_id, k, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, k ORDER BY n DESC, label) AS o FROM v)
WHERE o = 1""")
def q_knn(spark, d):
    """Nearest-neighbour classes of a quarter of the vectors from the other three quarters."""
    from kestrel.sources.tables import load
    e = load(spark, d, "embeddings").select("vec_id", "embedding", "label")
    return md.knn_votes(e.where("vec_id % 4 <> 0"), e.where("vec_id % 4 = 0"), KNN_KS, "vec_id", "embedding", "label")


# ---------------------------------------------------------------- trees / ensembles

@register("mdl_tree_reg")
def q_tree_reg(spark, d):
    tr, te = _kept(_reg(spark, d), FEATS, "label")
    return _reg_scores(spark, "tree", DecisionTreeRegressor(maxDepth=5, seed=0).fit(tr), te)


@register("mdl_rf_reg")
def q_rf_reg(spark, d):
    tr, te = _kept(_reg(spark, d), FEATS, "label")
    m = RandomForestRegressor(numTrees=20, maxDepth=5, minWeightFractionPerNode=0.0,
                              featureSubsetStrategy="sqrt", seed=0).fit(tr)
    return _reg_scores(spark, "forest", m, te)


@register("mdl_gbt_reg")
def q_gbt_reg(spark, d):
    tr, te = _kept(_reg(spark, d), FEATS, "label")
    return _reg_scores(spark, "gbt", GBTRegressor(maxIter=20, stepSize=0.1, maxDepth=3, seed=0).fit(tr), te)


# The searched parameters of second-order boosting.
XGB_ROUNDS = [10, 50, 100, 250, 500, 1000]
XGB_GRID = {"eta": [0.0001, 0.01, 0.05, 0.1, 0.2], "gamma": [0.0, 0.1, 0.2, 0.3, 0.4], "subsample": [0.5, 0.75, 1.0], "depth": [6]}


@register("mdl_xgb")
def q_xgb(spark, d):
    """Second-order boosting: 75 points and their shorter prefixes over 5 folds on scaled rows, the best
    refitted; mean and fold scores of every point, squared errors of the best on train and held-out rows."""
    from itertools import product

    from kestrel.operators import boosting as bo
    from kestrel.operators.encode import zscore
    df = _reg(spark, d).drop("features")
    cols = [*FEATS, "label"]
    z = zscore(df, cols, fit_on=df.where("split = 'train'"), suffix="_z")
    tr, te = _split(z)
    tr = with_contiguous_folds(tr, [], fx.REG_ORDER, 5)
    spread = tr.agg(F.stddev_pop("label")).first()[0]
    points = [bo.Point(*p) for p in product(*XGB_GRID.values())]
    rows, final, rounds = bo.search(tr, [f"{c}_z" for c in FEATS], "label_z", points, XGB_ROUNDS, "fold", 5)
    error = ((F.col("_p") - F.col("_y")) * F.lit(float(spread))) ** 2
    mse = [float(final.predict(x, final.fits[0], "label_z").agg(F.avg(error)).first()[0]) for x in (tr, te)]
    best = max(rows, key=lambda r: r[3])
    return spark.createDataFrame(
        [(p.eta, p.gamma, p.subsample, p.depth, r, own, mean, x is best, *(mse if x is best else (None, None)))
         for x in rows for p, r, own, mean in [x]],
        "eta double, gamma double, subsample double, depth int, rounds int, fold_r2 array<double>, mean_r2 double, "
        "best boolean, mse_train double, mse_test double")


@register("mdl_ada_reg")
def q_ada_reg(spark, d):
    tr, te = _split(_reg(spark, d))
    fitted = md.adaboost_r2(tr.drop("features"), FEATS, "label")
    p = stored(md.weighted_median(te, fitted).select("label", "prediction"))  # joined once for both scores
    s = RegressionEvaluator(labelCol="label")
    scores = [float(s.setMetricName(name).evaluate(p)) for name in ("rmse", "r2")]
    discard(p)
    return spark.createDataFrame([(len(fitted), [w for _, w, _ in fitted], [x for *_, x in fitted], *scores)],
                                 "rounds int, weights array<double>, losses array<double>, rmse double, r2 double")


@register("mdl_tree_cls")
def q_tree_cls(spark, d):
    tr, te = _kept(_cls(spark, d), CLS_FEATS, "y")
    return _cls_scores(spark, "tree", DecisionTreeClassifier(labelCol="y", maxDepth=5, seed=0).fit(tr), te)


@register("mdl_rf_cls")
def q_rf_cls(spark, d):
    tr, te = _kept(_cls(spark, d), CLS_FEATS, "y")
    m = RandomForestClassifier(labelCol="y", numTrees=20, maxDepth=5, seed=0).fit(tr)
    return _cls_scores(spark, "forest", m, te)


@register("mdl_gbt_cls")
def q_gbt_cls(spark, d):
    tr, te = _kept(_cls(spark, d), CLS_FEATS, "y")
    return _cls_scores(spark, "gbt", GBTClassifier(labelCol="y", maxIter=20, maxDepth=3, seed=0).fit(tr), te)


@register("mdl_ada_cls")
def q_ada_cls(spark, d):
    tr, te = _split(_cls(spark, d))
    fitted = md.adaboost_samme(tr.drop("features"), CLS_FEATS, "y", 2)
    p = md.weighted_vote(te, fitted, 2)
    acc = p.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    return spark.createDataFrame([(len(fitted), [w for _, w, _ in fitted], [x for *_, x in fitted], float(acc))],
                                 "rounds int, alphas array<double>, errors array<double>, accuracy double")


# ---------------------------------------------------------------- other classifiers

@register("mdl_logreg")
def q_logreg(spark, d):
    tr, te = _split(_cls(spark, d))
    return _cls_scores(spark, "logistic", LogisticRegression(labelCol="y", maxIter=10).fit(tr), te)


@register("mdl_svc_linear")
def q_svc(spark, d):
    tr, te = _split(_cls(spark, d))
    n = tr.count()
    m = LinearSVC(labelCol="y", regParam=1.0 / (0.025 * n), standardization=False, maxIter=50).fit(tr)
    return _cls_scores(spark, "linear_svc", m, te)


@register("cal_platt")
def q_platt(spark, d):
    """Platt scaling of the SVM margin: the sigmoid is fitted on margins of rows the SVM has not seen (5 folds),
    and applied to the test rows' margins of the SVM of all train rows."""
    from kestrel.operators import calibration as cal, svm
    tr, te, z = _zoo_parts(spark, d, True)
    tr = cut_lineage(tr.select("fold", "y", *z))
    fits = svm.Svm(tr, z, "y", {"linear": svm.linear}, [1.0], "fold", [-1, *range(5)])
    a, b = cal.platt(fits.margins(tr, "linear", 1.0, "fold"), "margin", "y")
    test = fits.margins(te.select("y", *z), "linear", 1.0).withColumnRenamed("margin", "m")
    return test.select("y", "m", cal.sigmoid(F.col("m"), a, b).alias("p1"))


SVC_CS = [0.025, 0.5, 1.0]


@register("mdl_kernel_approx")
def q_kernel_approx(spark, d):
    """Support vector classification with linear, polynomial (degree 3) and RBF kernels by explicit features and
    three C: accuracy on each of 5 held-out folds, its mean, and on the test rows for the fit on all train rows."""
    from kestrel.operators import svm
    tr, te, z = _zoo_parts(spark, d, True)
    tr, te = stored(tr.select("fold", "y", *z)), stored(te.select("y", *z))
    gamma = 1 / len(z)
    maps = {"linear": svm.linear, "poly": svm.tensor_sketch(len(z), gamma, 3, 64),
            "rbf": svm.nystroem(svm.bounded_sample(tr, z), gamma, 64)}
    fits = svm.Svm(tr, z, "y", maps, SVC_CS, "fold", [-1, *range(5)])
    held_out, test = fits.accuracy(tr, "y", "fold"), fits.accuracy(te, "y")
    rows = []
    for kernel in maps:
        for c in SVC_CS:
            cv = [held_out[kernel, c, f] for f in range(5) if (kernel, c, f) in held_out]
            rows.append((kernel, c, cv, float(sum(cv) / len(cv)), test[kernel, c, -1], fits.gradient[kernel, c, -1]))
    best = max(rows, key=lambda r: r[3])
    return spark.createDataFrame([(*r, r is best) for r in rows],
                                 "kernel string, c double, fold_accuracy array<double>, cv_accuracy double, test_accuracy double, "
                                 "gradient double, best boolean")


KERNELS = [("linear", 1.0), *[(k, g) for k in ("poly", "rbf") for g in (0.01, 0.1, 1.0, 10.0)]]
KERNEL_ALPHAS = [1e-4, 1e-2, 0.1, 1.0]


@register("mdl_kernel_ridge")
def q_kernel_ridge(spark, d):
    """Kernel ridge on explicit features (linear, polynomial of degree 2, RBF): 5-fold held-out r2 of
    every (kernel, gamma, alpha), and of each the refit's r2 on the test rows."""
    z = [f"{c}_z" for c in FEATS]
    tr, te = _scaled(spark, d)
    gram = md.kernel_gram(tr.unionByName(te.withColumn("fold", F.lit(-1).cast("long"))), z, "label_z", "fold", KERNELS)
    rows = []
    for i, (kernel, gamma) in enumerate(KERNELS):
        folds = [gram[i, f] for f in range(5) if (i, f) in gram]
        total = None
        for g in folds:
            total = g if total is None else linear.add(total, g)
        for alpha in KERNEL_ALPHAS:
            cv = [linear.r2_from_sums(g, linear.ridge_solve(linear.add(total, g, -1.0), alpha)) for g in folds]
            rows.append((kernel, gamma, alpha, float(sum(cv) / len(cv)),
                         linear.r2_from_sums(gram[i, -1], linear.ridge_solve(total, alpha))))
    return spark.createDataFrame(rows, "kernel string, gamma double, alpha double, cv_r2 double, test_r2 double")


@register("mdl_mlp_cls")
def q_mlp(spark, d):
    tr, te = _split(_cls(spark, d))
    m = MultilayerPerceptronClassifier(labelCol="y", layers=[len(CLS_FEATS), 8, 2], maxIter=50, seed=0).fit(tr)
    return _cls_scores(spark, "mlp", m, te)


CLS_VIEW = ("cls", "SELECT *, CASE WHEN l_quantity >= 25 THEN 1.0 ELSE 0.0 END AS y FROM reg_table")
NB_FEATS = ("label", "p_retailprice")


@register("mdl_nb_gauss", sql=with_views("""
SELECT y, prediction, count(*) AS n
FROM (SELECT c.y, (SELECT m.y FROM mom m ORDER BY ln(m.n / m.total)
        - 0.5 * ln(2 * pi() * (m.v1 + m.eps)) - (c.label - m.m1) ** 2 / (2 * (m.v1 + m.eps))
        - 0.5 * ln(2 * pi() * (m.v2 + m.eps)) - (c.p_retailprice - m.m2) ** 2 / (2 * (m.v2 + m.eps)) DESC LIMIT 1) AS prediction
      FROM cls c) GROUP BY 1, 2""", ["reg_table"], [CLS_VIEW, (
    "mom", "SELECT *, sum(n) OVER () AS total, 1e-9 * greatest(max(v1) OVER (), max(v2) OVER ()) AS eps FROM "
           "(SELECT y, count(*) AS n, avg(label) AS m1, avg(p_retailprice) AS m2, var_pop(label) AS v1, "
           "var_pop(p_retailprice) AS v2 FROM cls GROUP BY y)")]))
def q_nb(spark, d):
    """Confusion counts of the Gaussian naive Bayes expression."""
    c = fx.reg_table(spark, d).withColumn("y", (F.col("l_quantity") >= 25).cast("double"))
    p = md.gaussian_nb(c, list(NB_FEATS), "y")
    return p.groupBy("y", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _qda_sql(feats: list[str]) -> str:
    """Confusion counts of the discriminant: Cholesky factors and substitution written out."""
    k = len(feats)
    mom = ", ".join([f"avg({c}) AS m{i}" for i, c in enumerate(feats)] + [
        f"covar_samp({feats[i]}, {feats[j]}) AS c{i}{j}" for i in range(k) for j in range(i + 1)])

    def less(i, j):
        return "".join(f" - l{i}{m} * l{j}{m}" for m in range(j))
    factor = ", ".join([f"sqrt(c{i}{i}{less(i, i)}) AS l{i}{i}" if i == j else f"(c{i}{j}{less(i, j)}) / l{j}{j} AS l{i}{j}"
                        for i in range(k) for j in range(i + 1)])
    solved = ", ".join(f"({c} - m{j}" + "".join(f" - l{j}{i} * z{i}" for i in range(j)) + f") / l{j}{j} AS z{j}"
                       for j, c in enumerate(feats))
    score = "ln(n / total)" + "".join(f" - ln(l{j}{j}) - 0.5 * z{j} * z{j}" for j in range(k))
    return with_views(f"""
SELECT y, prediction, count(*) AS n FROM (SELECT any_value(y) AS y, arg_max(k, score) AS prediction FROM (
    SELECT rid, cls.y, f.y AS k, {solved}, {score} AS score FROM cls, f) GROUP BY rid) GROUP BY 1, 2""", ["reg_table"], [
        ("cls", "SELECT *, row_number() OVER () AS rid, CASE WHEN l_quantity >= 25 THEN 1.0 ELSE 0.0 END AS y FROM reg_table"),
        ("mom", f"SELECT y, count(*) AS n, sum(count(*)) OVER () AS total, {mom} FROM cls GROUP BY y"),
        ("f", f"SELECT *, {factor} FROM mom")])


@register("mdl_qda", sql=_qda_sql(CLS_FEATS))
def q_qda(spark, d):
    """Confusion counts of the quadratic discriminant on all class features."""
    c = fx.reg_table(spark, d).withColumn("y", (F.col("l_quantity") >= 25).cast("double"))
    p = md.qda(c, CLS_FEATS, "y")
    return p.groupBy("y", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register("mdl_ridge_uni", sql=with_views(
    "SELECT * FROM res", ["dataset_family"],
    q_ticks.ridge_uni_sql("dataset_family", ["dataset_id"], ["x"], "y",
                          "l_orderkey, l_linenumber, l_partkey, x, y")))
def q_ridge_uni(spark, d):
    rows = fx.dataset_family(spark, d)
    sums = linear.fold_sums_uni(rows, ["dataset_id"], ["x"], "y", ["l_orderkey", "l_linenumber", "l_partkey", "x", "y"])
    return linear.ridge_uni_cv(sums, ["dataset_id"])


@register("tun_grid", sql=with_views(
    "SELECT dataset_id, feature, alpha, cv_r2 FROM cv", ["dataset_family"],
    q_ticks.ridge_uni_sql("dataset_family", ["dataset_id"], ["x"], "y",
                          "l_orderkey, l_linenumber, l_partkey, x, y")[:-1]))
def q_grid(spark, d):
    """Mean CV score of every grid point (not only the best)."""
    rows = fx.dataset_family(spark, d)
    sums = linear.fold_sums_uni(rows, ["dataset_id"], ["x"], "y", ["l_orderkey", "l_linenumber", "l_partkey", "x", "y"])
    from pyspark.sql import Window
    s = sums
    for c in ["n", "sy", "syy", "sxx", "sxy"]:
        s = s.withColumn("T" + c, F.sum(c).over(Window.partitionBy("dataset_id", "feature")))
    al = spark.createDataFrame([(float(a),) for a in linear.RIDGE_ALPHAS], "alpha double")
    g = s.crossJoin(F.broadcast(al))
    b = F.try_divide(F.col("Tsxy") - F.col("sxy"), F.col("Tsxx") - F.col("sxx") + F.col("alpha"))
    g = g.withColumn("_b", b)
    ssres = F.col("syy") - 2 * F.col("_b") * F.col("sxy") + F.col("_b") * F.col("_b") * F.col("sxx")
    sstot = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return g.groupBy("dataset_id", "feature", "alpha").agg(F.avg(F.lit(1.0) - F.try_divide(ssres, sstot)).alias("cv_r2"))


@register("tun_per_dataset", sql=with_views("""
SELECT dataset_id, n, slope, intercept,
       1.0 - (syy - 2 * intercept * sy - 2 * slope * sxy + n * intercept * intercept + 2 * intercept * slope * sx
              + slope * slope * sxx) / NULLIF(syy - sy * sy / n, 0) AS r2
FROM (SELECT *, (sxy - sx * sy / n) / NULLIF(sxx - sx * sx / n, 0) AS slope,
             sy / n - (sxy - sx * sy / n) / NULLIF(sxx - sx * sx / n, 0) * sx / n AS intercept
      FROM (SELECT dataset_id, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy,
                   sum(y * y) AS syy FROM dataset_family GROUP BY dataset_id))""",
                                              ["dataset_family"]))
def q_per_dataset(spark, d):
    """Ordinary least squares y ~ x per dataset, whatever its size (one aggregate)."""
    df = fx.dataset_family(spark, d)
    s = df.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
                                     F.sum(F.col("x") * F.col("x")).alias("sxx"),
                                     F.sum(F.col("x") * F.col("y")).alias("sxy"),
                                     F.sum(F.col("y") * F.col("y")).alias("syy"))
    slope = F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n"),
                         F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"))
    s = s.withColumn("slope", slope).withColumn("intercept", F.col("sy") / F.col("n") - F.col("slope") * F.col("sx") / F.col("n"))
    a, b = F.col("intercept"), F.col("slope")
    ssres = (F.col("syy") - 2 * a * F.col("sy") - 2 * b * F.col("sxy") + F.col("n") * a * a
             + 2 * a * b * F.col("sx") + b * b * F.col("sxx"))
    return s.select("dataset_id", "n", "slope", "intercept",
                    (F.lit(1.0) - F.try_divide(ssres, F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))).alias("r2"))


# Penalties of the searches per data set.
PER_DATASET = {"ridge": [0.01, 0.1, 1.0, 10.0], "lasso": LASSO_ALPHAS}


@register("tun_per_dataset_cv")
def q_per_dataset_cv(spark, d):
    """Ridge and lasso for every data set: split, 5 contiguous folds, chosen penalty, r2 on train and held-out rows."""
    from kestrel.operators import per_group as pg
    from kestrel.operators.sampling import split_by_key
    from kestrel.sources.tables import load
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    li = split_by_key(load(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("dataset_id"), "l_quantity", "l_discount", "l_tax",
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("price"), *order), "l_orderkey", 0.75)
    tr, te = _split(li)
    rows = with_contiguous_folds(tr, ["dataset_id"], order, 5).unionByName(te.withColumn("fold", F.lit(-1).cast("long")))
    return pg.search(rows, "dataset_id", ["l_quantity", "l_discount", "l_tax"], "price", "fold", 5, PER_DATASET)


LEARN_SIZES = list(range(20, 481, 10))


@register("tun_learning_curve", sql=with_views(f"""
SELECT size, avg(train_r2) AS train_r2, avg(valid_r2) AS valid_r2 FROM (
  SELECT size, fold,
         regr_r2(label, x) FILTER (WHERE rfold <> fold) AS train_r2,
         any_value(valid_r2) AS valid_r2
  FROM scored WHERE pos <= size GROUP BY size, fold) GROUP BY size""", ["reg_table"], [
    ("r", f"SELECT label, l_quantity AS x, {q_ticks._fold_expr()} AS rfold, rn FROM (SELECT *, row_number() OVER (ORDER BY "
          f"{', '.join(fx.REG_ORDER)}) AS rn, count(*) OVER () AS n FROM reg_table)"),
    ("f", "SELECT r.*, k.fold, row_number() OVER (PARTITION BY k.fold ORDER BY rn) AS pos "
          "FROM r JOIN (SELECT unnest(range(0, 5)) AS fold) k ON r.rfold <> k.fold"),
    ("sz", f"SELECT unnest({list(range(20, 481, 10))}) AS size"),
    ("fit", "SELECT size, fold, regr_slope(label, x) AS b, regr_intercept(label, x) AS a FROM f JOIN sz ON pos <= size "
            "GROUP BY 1, 2"),
    ("val", "SELECT size, fit.fold, 1 - sum((label - a - b * x) ** 2) / (var_pop(label) * count(*)) AS valid_r2 "
            "FROM fit JOIN r ON r.rfold = fit.fold GROUP BY 1, 2"),
    ("scored", "SELECT f.*, sz.size, val.valid_r2 FROM f JOIN sz ON f.pos <= sz.size "
               "JOIN val ON val.size = sz.size AND val.fold = f.fold")]))
def q_learning_curve(spark, d):
    """Mean train / validation r2 of OLS label ~ l_quantity per training size
    (contiguous 5 folds, first `size` training rows), from prefix sums."""
    from kestrel.operators.sampling import fold_prefixes
    r = fx.reg_table(spark, d).select(*fx.REG_ORDER, F.col("l_quantity").alias("x"))
    pre = fold_prefixes(r, fx.REG_ORDER, 5, LEARN_SIZES)
    fit = pre.groupBy("fold", "size").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("label").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("label")).alias("sxy"),
        F.sum(F.col("label") * F.col("label")).alias("syy"))
    slope = F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n"), F.col("sxx") - F.col("sx") ** 2 / F.col("n"))
    fit = fit.withColumn("b", slope).withColumn("a", F.col("sy") / F.col("n") - F.col("b") * F.col("sx") / F.col("n"))
    folds = with_contiguous_folds(r, [], fx.REG_ORDER, 5).groupBy("fold").agg(
        F.count(F.lit(1)).alias("vn"), F.sum("x").alias("vsx"), F.sum("label").alias("vsy"),
        F.sum(F.col("x") ** 2).alias("vsxx"), F.sum(F.col("x") * F.col("label")).alias("vsxy"),
        F.sum(F.col("label") ** 2).alias("vsyy"))

    def r2(n, sx, sy, sxx, sxy, syy):
        a, b = F.col("a"), F.col("b")
        ss = F.col(syy) - 2 * a * F.col(sy) - 2 * b * F.col(sxy) + F.col(n) * a * a + 2 * a * b * F.col(sx) + b * b * F.col(sxx)
        return F.lit(1.0) - F.try_divide(ss, F.col(syy) - F.col(sy) ** 2 / F.col(n))
    j = fit.join(F.broadcast(folds), "fold")
    j = j.withColumn("train_r2", r2("n", "sx", "sy", "sxx", "sxy", "syy")).withColumn(
        "valid_r2", r2("vn", "vsx", "vsy", "vsxx", "vsxy", "vsyy"))
    return j.groupBy("size").agg(F.avg("train_r2").alias("train_r2"), F.avg("valid_r2").alias("valid_r2"))


@register("tun_cv")
def q_tun_cv(spark, d):
    """Text pipeline (tokenize -> hashed tf -> logistic) x 6 grid points x 2 folds."""
    docs = fx.docs_labeled(spark, d).withColumn("fold", (F.col("id") % 2).cast("int"))
    grid, scores, _ = md.text_search(docs, BinaryClassificationEvaluator(numBins=0), "fold", 2)
    return spark.createDataFrame([(i, str(sorted((p.name, v) for p, v in pm.items())), float(m))
                                  for i, (pm, m) in enumerate(zip(grid, scores))],
                                 "grid_id int, params string, mean_auc double")


@register("prd_transform")
def q_prd_transform(spark, d):
    """Fit the best text model (2-fold search over the grid) on labelled documents and score
    every document."""
    from kestrel.sources.tables import load
    docs = fx.docs_labeled(spark, d).withColumn("fold", (F.col("id") % 2).cast("int"))
    *_, model = md.text_search(docs, BinaryClassificationEvaluator(numBins=0), "fold", 2)
    alld = load(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return model.transform(alld).select("id", vector_to_array("probability").alias("probability"), "prediction")


@register("prd_surface")
def q_prd_surface(spark, d):
    """Decision surface: P(class 1) on a mesh over the two feature ranges."""
    from kestrel.sources.synthetic import mesh
    c = fx.reg_table(spark, d).withColumn("y", (F.col("l_quantity") >= 25).cast("double"))
    m = LogisticRegression(labelCol="y", maxIter=20).fit(md.assemble(c, ["label", "p_retailprice"]))
    grid = mesh(c, "label", "p_retailprice", steps=20)
    p = m.transform(md.assemble(grid, ["label", "p_retailprice"]))
    return p.select("label", "p_retailprice", vector_to_array("probability")[1].alias("p1"))


@register("prd_export", sql=with_views("""
SELECT doc_id AS id, CASE WHEN p1 > 1.0 - p1 THEN 1 ELSE 0 END AS pred_label,
       [1.0 - p1, p1] AS pred_score, target AS true_label FROM scores""", ["scores"]))
def q_prd_export(spark, d):
    s = fx.scores(spark, d)
    return s.select(F.col("doc_id").alias("id"),
                    F.when(F.col("p1") > F.lit(1.0) - F.col("p1"), 1).otherwise(0).alias("pred_label"),
                    F.array(F.lit(1.0) - F.col("p1"), F.col("p1")).alias("pred_score"),
                    F.col("target").alias("true_label"))


@register("udf_scorer")
def q_scorer(spark, d):
    """Cross-validation scored by a custom evaluator (exact r2 from kestrel metrics)."""
    tr, _ = _split(_reg(spark, d))
    dt = DecisionTreeRegressor(seed=0)
    from pyspark.ml.tuning import ParamGridBuilder
    grid = ParamGridBuilder().addGrid(dt.maxDepth, [2, 4]).build()
    tr = with_contiguous_folds(tr, [], fx.REG_ORDER, 3, out="fold").withColumn("fold", F.col("fold").cast("int"))
    cvm = md.cross_validate(dt, grid, tr, md.MetricEvaluator("r2"), fold_col="fold", k=3)
    return spark.createDataFrame([(g[dt.maxDepth], float(m)) for g, m in zip(grid, cvm.avgMetrics)],
                                 "max_depth int, mean_r2 double")


ZOO_SCHEMA = "model string, kind string, grid_id int, params string, fold int, score double"
# The zoo's grids of tree ensembles; sqrt, log2 and all of five features are 2, 2 and 5 of them.
FOREST_GRID = [(leaf, n / 5) for leaf in (0.0, 0.25, 0.5) for n in (2, 2, 5)]
FOREST_TREES, BOOST_TREES = [10, 100, 1000], [10, 100, 1000]
CLS_FOREST_GRID = [(depth, n / 5) for depth in (5, 10) for n in (1, 2, 5)]
CLS_FOREST_TREES, CLS_BOOST_TREES = [10, 20], [50, 100]
CLS_KNN_KS, CLS_KNN_ALGORITHMS = [5, 8], ["auto", "ball_tree", "kd_tree", "brute"]
CLS_BOOST_GRID = [(eta, depth, leaf) for eta in (0.05, 0.1) for depth in (3, 5) for leaf in (0.0, 0.25)]


def _zoo_parts(spark, d, cls: bool):
    """Scaled and assembled train rows with 5 folds, and test rows; the scaled columns stay."""
    from kestrel.operators.encode import zscore
    feats, label = (CLS_FEATS, "y") if cls else ([*FEATS, "label"], "label_z")
    df = (_cls if cls else _reg)(spark, d).drop("features")
    z = zscore(df, feats, fit_on=df.where("split = 'train'"), suffix="_z")
    names = [f"{c}_z" for c in feats if cls or c != "label"]
    z = md.assemble(z, names).select(*fx.REG_ORDER, label, "split", "features", *names)
    tr, te = _split(z)
    return with_contiguous_folds(tr, [], fx.REG_ORDER, 5), te, names


@register("tun_model_zoo")
def q_zoo(spark, d):
    """The regressors of the zoo: 5-fold search over their grids, refit of the best, r2 on train and held-out rows.
    What is left out of the grids stands in the README."""
    tr, te, z = _zoo_parts(spark, d, False)
    tr, te = cut_lineage(tr), cut_lineage(te)

    def r2(model, rows):
        return RegressionEvaluator(labelCol="label_z", metricName="r2").evaluate(model.transform(rows))
    with ThreadPool(1) as beside:  # the jobs of the fits one by one fill what those of the sums and trees leave idle
        found = beside.apply_async(md.model_search, (tr.select("features", "label_z", "fold"), te, md.regressor_zoo("label_z"), r2))
        rest = _zoo_rest(tr, te, z)
        return spark.createDataFrame(found.get() + rest, ZOO_SCHEMA)


def _zoo_rest(tr, te, z):
    """The search rows of the regressors that are fitted from sums, and of forests and boosting."""
    from kestrel.operators import boosting as bo
    rows = []
    sums = {r["fold"]: linear.unpack_gram(r, len(z)) for r in linear.gram_sums(
        tr.select("fold", *z, "label_z").unionByName(te.select(F.lit(-1).alias("fold"), *z, "label_z")), ["fold"], z, "label_z").collect()}
    folds = [sums[f] for f in sorted(sums) if f >= 0]

    def net(alpha, l1):
        return lambda g: md.elastic_net(g, alpha, l1)
    for name, points in (("linear", [("", net(0.0, 0.0))]),
                         ("lasso", [(f"alpha={a}", net(a, 1.0)) for a in LASSO_ALPHAS]),
                         ("sgd", [(f"alpha={a}, penalty={p}", net(a, l1)) for p, l1, a in SGD_GRID])):
        rows += [(name, *r) for r in md.gram_search(folds, sums[-1], points, linear.r2_with_intercept)]
    svr = md.svr_fit(tr, z, "label_z", SVR_GRID, fold_col="fold", folds=(-1, *range(len(folds))))
    rows += [("linear_svr", *r) for r in md.fold_rows(folds, sums[-1], [f"C={c}, loss={loss}" for loss, c in SVR_GRID],
                                                       [w for w, *_ in svr], linear.r2_with_intercept)]
    gram = md.kernel_gram(tr.select("fold", *z, "label_z").unionByName(te.select(F.lit(-1).cast("long").alias("fold"), *z, "label_z")),
                          z, "label_z", "fold", KERNELS)

    def ridge(k, alpha):
        return lambda g: linear.ridge_solve(g, alpha)
    for k, (kernel, gamma) in enumerate(KERNELS):
        points = [(f"alpha={a}, gamma={gamma}, kernel={kernel}", ridge(k, a)) for a in KERNEL_ALPHAS]
        rows += [(f"kernel_ridge_{kernel}_{gamma}", *r) for r in md.gram_search(
            [gram[k, f] for f in range(5) if (k, f) in gram], gram[k, -1], points, linear.r2_from_sums)]

    forest = [bo.Point(eta=1.0, depth=6, min_leaf=leaf, columns=c, by_node=True, forest=True) for leaf, c in FOREST_GRID]
    rows += [("forest", *r) for r in md.tree_search(tr, te, z, "label_z", forest, FOREST_TREES, "fold", 5, lam=0.0)]
    boost = [bo.Point(eta=0.1, depth=3, min_leaf=leaf, columns=c, by_node=True) for leaf, c in FOREST_GRID]
    return rows + [("boosting", *r) for r in md.tree_search(tr, te, z, "label_z", boost, BOOST_TREES, "fold", 5, lam=0.0)]


@register("tun_model_zoo_cls")
def q_zoo_cls(spark, d):
    """The classifiers of the zoo: 5-fold search over their grids, refit of the best, AUC
    on train and held-out rows.  What is left out of the grids stands in the README."""
    from kestrel.operators import boosting as bo
    tr, te, z = _zoo_parts(spark, d, True)
    tr, te = cut_lineage(tr), cut_lineage(te)

    def auc(model, rows):
        return BinaryClassificationEvaluator(labelCol="y", numBins=0).evaluate(model.transform(rows))
    with ThreadPool(1) as beside:
        found = beside.apply_async(md.model_search, (tr.select("features", "y", "fold"), te, md.classifier_zoo("y"), auc))
        forest = [bo.Point(eta=1.0, depth=depth, columns=c, by_node=True, forest=True) for depth, c in CLS_FOREST_GRID]
        rest = [("knn", *r) for r in md.knn_search(tr, te, z, "y", CLS_KNN_KS, CLS_KNN_ALGORITHMS)]
        rest += [("forest", *r) for r in md.tree_search(tr, te, z, "y", forest, CLS_FOREST_TREES, "fold", 5, lam=0.0, metric="auc")]
        boost = [bo.Point(eta=eta, depth=depth, min_leaf=leaf) for eta, depth, leaf in CLS_BOOST_GRID]
        rest += [("boosting", *r) for r in md.tree_search(tr, te, z, "y", boost, CLS_BOOST_TREES, "fold", 5, lam=0.0,
                                                          loss="logistic", metric="auc")]
        return spark.createDataFrame(found.get() + rest, ZOO_SCHEMA)


@register("agg_param_count")
def q_param_count(spark, d):
    tr, _ = _split(_reg(spark, d))
    lin = LinearRegression(maxIter=5).fit(tr)
    tree = DecisionTreeRegressor(maxDepth=4).fit(tr)
    return spark.createDataFrame([("linear", len(lin.coefficients) + 1), ("tree", tree.numNodes)],
                                 "model string, n_params int")


@register("snk_model")
def q_snk_model(spark, d):
    """Save the pipeline of every epoch below the shared folder, keep the table of their scores,
    resume from the last one, and reload the best: its score must come out again."""
    from pyspark.ml import Pipeline, PipelineModel
    tr, te = _kept(_reg(spark, d), FEATS, "label")
    base = os.path.join(checkpoint_dir(spark), "models", uuid.uuid4().hex)
    ev = RegressionEvaluator(labelCol="label", metricName="rmse")
    for epoch in range(4):
        done = []
        if epoch:  # a restarted run goes on after the last epoch in the table
            done = [r.epoch for r in spark.read.parquet(f"{base}/scores").collect()]
        at = max(done, default=-1) + 1
        model = Pipeline(stages=[GBTRegressor(maxIter=1 + 2 * at, maxDepth=3, seed=0)]).fit(tr)
        model.write().overwrite().save(f"{base}/epoch-{at}")
        spark.createDataFrame([(at, float(ev.evaluate(model.transform(te))))], "epoch int, rmse double").write.mode(
            "append").parquet(f"{base}/scores")
    scores = spark.read.parquet(f"{base}/scores")
    best = scores.agg(F.min_by("epoch", "rmse")).first()[0]
    again = float(ev.evaluate(PipelineModel.load(f"{base}/epoch-{best}").transform(te)))
    return scores.select("epoch", "rmse", (F.col("epoch") == best).alias("is_best"), F.lit(again).alias("reloaded_rmse"))


# ---------------------------------------------------------------- multivariate ridge on ticks

def _tick_ridge(spark, d):
    feats = [s.out for s in tk.FEATURE_SPEC]
    rows = tk.lagged_features(q_ticks._split(spark, d))
    train = with_contiguous_folds(rows.where("split = 'train'"), ["symbol", "horizon"], ["bin"], 5,
                                  dense_col="bin")
    g_train = linear.gram_sums(train, ["symbol", "horizon", "fold"], feats, "target").collect()
    g_test = linear.gram_sums(rows.where("split = 'test'"), ["symbol", "horizon"], feats, "target").collect()
    return feats, rows, g_train, g_test


@register("mdl_ridge")
def q_ridge(spark, d):
    """11-feature ridge, no intercept, alpha in (0.01, 0.1, 1), contiguous 5-fold CV,
    per (symbol, horizon): r2 on train (refit) and on test, from Gram sums."""
    feats, _, g_train, g_test = _tick_ridge(spark, d)
    k = len(feats)
    folds: dict = {}
    for r in g_train:
        folds.setdefault((r["symbol"], r["horizon"]), {})[r["fold"]] = linear.unpack_gram(r, k)
    tests = {(r["symbol"], r["horizon"]): linear.unpack_gram(r, k) for r in g_test}
    out = []
    for key, fd in sorted(folds.items()):
        alpha, beta, _ = linear.ridge_cv_from_folds(fd)
        total = None
        for g in fd.values():
            total = g if total is None else linear.add(total, g)
        te = tests.get(key)
        out.append((key[0], int(key[1]), float(alpha), linear.r2_from_sums(total, beta),
                    linear.r2_from_sums(te, beta) if te else None))
    return spark.createDataFrame(out, "symbol string, horizon int, best_alpha double, r2_train double, r2_test double")


def cross_symbol_rows(spark, d, features_of: str, target_of: str):
    """Feature rows of one symbol next to the target of another, matched on bin."""
    rows = tk.lagged_features(q_ticks._split(spark, d))
    a = rows.where(F.col("symbol") == features_of).drop("symbol")
    b = rows.where(F.col("symbol") == target_of).select("split", "horizon", "bin", F.col("target").alias("target_b"))
    return a.join(b, ["split", "horizon", "bin"])


def _two_symbols(spark, d):
    """The first two symbols by name."""
    return [r[0] for r in fx.ticks(spark, d).select("symbol").distinct().orderBy("symbol").take(2)]


@register("jn_cross_symbol", sql=q_ticks._with(q_ticks.feature_ctes(), """
SELECT a.split, a.horizon, corr(a.target, b.target) AS corr_targets, count(*) AS n
FROM feat a JOIN feat b ON a.split = b.split AND a.horizon = b.horizon AND a.bin = b.bin
WHERE a.symbol = 'STOCKA' AND b.symbol = 'STOCKB' GROUP BY 1, 2"""))
def q_cross_symbol(spark, d):
    """Correlation of the two symbols' targets per split and horizon."""
    j = cross_symbol_rows(spark, d, *_two_symbols(spark, d))
    return j.groupBy("split", "horizon").agg(F.corr("target", "target_b").alias("corr_targets"), F.count(F.lit(1)).alias("n"))


@register("jn_cross_symbol_fit")
def q_cross_symbol_fit(spark, d):
    """Ridge of the second symbol's target on the first one's features: alpha by 5-fold search on
    the train split, r2 there and on the test split."""
    feats = [s.out for s in tk.FEATURE_SPEC]
    j = cross_symbol_rows(spark, d, *_two_symbols(spark, d))
    train = with_contiguous_folds(j.where("split = 'train'"), ["horizon"], ["bin"], 5, dense_col="bin")
    folds: dict = {}
    for r in linear.gram_sums(train, ["horizon", "fold"], feats, "target_b").collect():
        folds.setdefault(r["horizon"], {})[r["fold"]] = linear.unpack_gram(r, len(feats))
    tests = {r["horizon"]: linear.unpack_gram(r, len(feats))
             for r in linear.gram_sums(j.where("split = 'test'"), ["horizon"], feats, "target_b").collect()}
    out = []
    for h, parts in sorted(folds.items()):
        alpha, beta, scores = linear.ridge_cv_from_folds(parts)
        total = None
        for g in parts.values():
            total = g if total is None else linear.add(total, g)
        out.append((int(h), float(alpha), max(scores), linear.r2_from_sums(total, beta),
                    linear.r2_from_sums(tests[h], beta) if h in tests else None))
    return spark.createDataFrame(out, "horizon int, best_alpha double, cv_r2 double, r2_train double, r2_test double")
