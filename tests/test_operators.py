"""Closed forms and invariants of the custom operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def test_contiguous_fold_sizes(spark):
    from kestrel.operators.order import with_contiguous_folds
    df = spark.range(23).withColumnRenamed("id", "k")
    f = with_contiguous_folds(df, [], ["k"], 5).groupBy("fold").agg(F.count("*").alias("n"), F.min("k").alias("lo"))
    got = sorted((r["fold"], r["n"], r["lo"]) for r in f.collect())
    assert got == [(0, 5, 0), (1, 5, 5), (2, 5, 10), (3, 4, 15), (4, 4, 19)]


def test_row_number_global_and_grouped(spark):
    from kestrel.operators.order import row_number
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "k": rng.permutation(500)})
    df = spark.createDataFrame(pdf)
    glob = {r["k"]: r["rn"] for r in row_number(df, [], ["k"], "rn").collect()}
    assert all(glob[k] == k + 1 for k in range(500))
    grp = row_number(df, ["g"], ["k"], "rn").toPandas()
    exp = pdf.sort_values(["g", "k"]).assign(rn=lambda x: x.groupby("g").cumcount() + 1)
    m = grp.merge(exp, on=["g", "k"], suffixes=("", "_e"))
    assert (m["rn"] == m["rn_e"]).all() and len(m) == 500


def test_running_sum(spark):
    from kestrel.operators.order import running_sum
    df = spark.range(1, 101).withColumn("v", F.col("id").cast("double"))
    got = {r["id"]: r["v_cum"] for r in running_sum(df, [], ["id"], ["v"]).collect()}
    assert all(got[i] == i * (i + 1) / 2 for i in range(1, 101))


def _beta_loop(x, y, h, cutoff=200):
    istart = 0
    while math.isnan(x[istart]) or math.isnan(y[istart]):
        istart += 1
    out = [float("nan")] * istart
    d = 2.0 ** (-1.0 / h)
    sw, wx, wxx, wy, wxy = d, 0.0, 0.0, 0.0, 0.0
    for i in range(istart, len(y)):
        if math.isnan(x[i]) or math.isnan(y[i]):
            out.append(float("nan"))
            continue
        out.append(float("nan") if i < istart + cutoff else (wxy - wx * wy / sw) / (wxx - wx * wx / sw))
        sw, wx, wxx, wy, wxy = d * (sw + 1), d * (wx + x[i]), d * (wxx + x[i] * x[i]), d * (wy + y[i]), d * (wxy + x[i] * y[i])
    return out


def test_ewm_beta_matches_loop(spark):
    from kestrel.operators.panel import ewm_beta
    rng = np.random.default_rng(1)
    n = 600
    x = rng.normal(size=n)
    y = 0.7 * x + rng.normal(scale=0.5, size=n)
    y[[0, 1, 50, 51, 300]] = np.nan
    pdf = pd.DataFrame({"uspn": "S", "pos": np.arange(1, n + 1), "x": x, "y": y, "half_life": 30})
    df = spark.createDataFrame(pdf.astype({"y": "float64"})).withColumn(
        "y", F.when(F.isnan("y"), None).otherwise(F.col("y")))
    got = {r["pos"]: r["beta"] for r in ewm_beta(df, ["uspn"]).collect()}
    exp = _beta_loop(list(x), list(y), 30)
    for i in range(n):
        e, g = exp[i], got.get(i + 1)
        if math.isnan(e):
            assert g is None
        else:
            assert g == pytest.approx(e, rel=1e-9, abs=1e-12)


def test_auc_equals_rank_statistic(spark):
    from kestrel.operators.metrics import auc
    rng = np.random.default_rng(2)
    s = np.round(rng.random(300), 2)
    y = (rng.random(300) < s).astype(int)
    got = auc(spark.createDataFrame(pd.DataFrame({"y": y, "s": s})), "y", "s").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    u = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(u, rel=1e-12)


def test_auc_single_class(spark):
    from kestrel.operators.metrics import auc
    df = spark.createDataFrame(pd.DataFrame({"y": [1, 1, 1], "s": [0.1, 0.2, 0.3]}))
    assert auc(df, "y", "s").first()["auc"] == -1e8


def test_html_rows_extracts_cells(spark):
    from kestrel.operators.text import html_rows
    html = ('<table class="tabledataformat"><tr class="altrow datarowSeparator"><td>Density</td><td>7.8</td>'
            '<td>0.28</td><td>x</td></tr><tr class=" datarowSeparator"><td>CTE</td><td>1</td><td>2</td>'
            '<td></td></tr><tr class="other"><td>no</td></tr></table>')
    got = html_rows(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    assert [(r["name"], r["Metric"], r["English"], r["Comments"]) for r in got] == [
        ("Density", "7.8", "0.28", "x"), ("CTE", "1", "2", "")]


def test_slug(spark):
    from kestrel.functions.scalar import slug
    long = "a b" * 200
    r = spark.createDataFrame([("x y/z,w",), (long,)], "s string").select(slug(F.col("s")).alias("o")).collect()
    assert r[0]["o"] == "x_y_zw"
    assert len(r[1]["o"]) == 243 and r[1]["o"].endswith("...")


def test_gap_fill_repeats_previous_bin(spark):
    from kestrel.operators.ticks import gap_fill, tick_bins
    rows = [("A", 0, 10.0, 1.0, 11.0, 2.0, 0.0, 0.0, 0.0),
            ("A", 5, 0.0, 0.0, 0.0, 0.0, 10.5, 3.0, 1.0),
            ("A", 30, 12.0, 1.0, 13.0, 1.0, 0.0, 0.0, 0.0)]
    t = spark.createDataFrame(rows, "symbol string, time long, bid double, bidsz double, ask double, "
                                    "asksz double, trdpx double, trdsz double, trdsd double")
    out = {r["bin"]: r for r in gap_fill(tick_bins(t, 10, 0)).collect()}
    assert sorted(out) == [0, 1, 2, 3]
    assert out[0]["P_trd"] == pytest.approx(0.5) and out[0]["V_trd"] == pytest.approx(1.0)
    assert out[1]["P_bid"] == 10.0 and out[1]["P_trd"] == pytest.approx(0.5)  # empty bin repeats bin 0
    assert out[3]["P_bid"] == 12.0 and out[3]["P_trd"] == 0.0
