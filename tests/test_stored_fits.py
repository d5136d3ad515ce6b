"""Fits that read their rows many times: rows stored once, all scores in one pass, starts from a sample."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from kestrel.operators import models as md, svm


def rows(n=400, seed=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 2))
    return pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": (x[:, 0] + 0.5 * r.normal(size=n) > 0.2).astype(float),
                         "fold": np.arange(n) % 3})


def test_accuracy_of_all_fits_is_that_of_their_margins(spark):
    df = spark.createDataFrame(rows()).withColumn("a", F.when(F.col("b") < 2, F.col("a")))  # some nulls
    fits = svm.Svm(df, ["a", "b"], "y", {"linear": svm.linear, "poly": svm.tensor_sketch(2, 0.5, 2, 16)}, [0.1, 1.0], "fold", [-1, 0, 1, 2])
    right = F.avg(((F.col("margin") > 0) == (F.col("y") > 0.5)).cast("double"))
    held_out, whole = fits.accuracy(df, "y", "fold"), fits.accuracy(df, "y")
    assert len(held_out) == 12 and len(whole) == 4
    for name, c, _ in whole:
        assert whole[name, c, -1] == pytest.approx(fits.margins(df, name, c).agg(right).first()[0])
        for f, want in fits.margins(df, name, c, "fold").groupBy("fold").agg(right).collect():
            assert held_out[name, c, f] == pytest.approx(want)


def test_a_start_from_a_sample_ends_at_the_same_fit(spark, monkeypatch):
    df = spark.createDataFrame(rows())
    cold = svm.Svm(df, ["a", "b"], "y", {"linear": svm.linear}, [0.1, 1.0], "fold", [-1, 0], tol=1e-9)
    sizes, solve = [], svm.Svm._solve
    monkeypatch.setattr(svm, "WARM_ROWS", 100)
    monkeypatch.setattr(svm.Svm, "_solve", lambda self, *a: (sizes.append(self._rows.count()), solve(self, *a))[1])
    warm = svm.Svm(df, ["a", "b"], "y", {"linear": svm.linear}, [0.1, 1.0], "fold", [-1, 0], tol=1e-9)
    assert 0 < sizes[0] < 200 and sizes[1] == 400
    for fit, w in cold.weights.items():
        assert np.allclose(warm.weights[fit], w, atol=1e-6)


def test_text_search_is_that_of_the_pipeline(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{'good' if i % 3 else 'bad'} w{i % 7} x{i % 5}", float(i % 3 > 0 or i % 11 == 0), i % 2)
                                  for i in range(80)], "id long, text string, label double, fold int")
    ev = BinaryClassificationEvaluator(numBins=0)
    pipe, grid = md.text_pipeline()
    want = md.cross_validate(pipe, grid, docs, ev, fold_col="fold", k=2)
    kept = []
    monkeypatch.setattr(md, "stored", lambda df, write=md.stored: kept.append(write(df)) or kept[-1])
    got_grid, scores, model = md.text_search(docs, ev, "fold", 2)
    assert [sorted((p.name, v) for p, v in g.items()) for g in got_grid] == [sorted((p.name, v) for p, v in g.items()) for g in grid]
    assert len(kept) == 1 and "text" not in kept[0].columns and np.allclose(scores, want.avgMetrics, atol=1e-9)
    a, b = ({r.id: r.probability[1] for r in m.transform(docs).collect()} for m in (want.bestModel, model))
    assert a == pytest.approx(b, abs=1e-9)


def test_boosting_over_weights_stores_plain_columns(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(md, "stored", lambda df, write=md.stored: kept.append(write(df)) or kept[-1])
    fitted = md.adaboost_r2(spark.createDataFrame(rows()), ["a", "b"], "y", rounds=3, depth=2)
    assert all(k.columns == ["a", "b", "y", "_w"] for k in kept) and len(kept) == len(fitted)


def test_train_and_test_rows_are_joined_once(spark):
    from kestrel.plans import q_models as qm
    df = spark.createDataFrame(rows()).withColumn("split", F.when(F.col("fold") > 0, "train").otherwise("test"))
    joined = df.join(spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "fold int, z double"), "fold")
    tr, te = qm._kept(joined, ["a", "z"], "y")
    assert (tr.count(), te.count()) == (266, 134) and "Join" not in tr._jdf.queryExecution().toString()
    assert sorted(r.features[1] for r in te.distinct().collect())[0] == 1.0


@pytest.mark.parametrize("fit", [lambda df: md.adaboost_r2(df, ["a", "b"], "y", rounds=5, depth=2),
                                 lambda df: md.adaboost_samme(df, ["a", "b"], "y", 2, rounds=5)])
def test_boosting_over_weights_keeps_two_copies_at_most(spark, monkeypatch, fit):
    import os
    kept, standing = [], []

    def stored(df, write=md.stored):
        kept.append(write(df))
        standing.append(sum(os.path.exists(k.stored_at.removeprefix("file:")) for k in kept))
        return kept[-1]
    monkeypatch.setattr(md, "stored", stored)
    assert len(fit(spark.createDataFrame(rows()))) > 2
    assert standing == [1] + [2] * (len(kept) - 1) and len(kept) > 2
    assert not any(os.path.exists(k.stored_at.removeprefix("file:")) for k in kept)
