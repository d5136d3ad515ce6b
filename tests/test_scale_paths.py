"""Paths that only large inputs take, on small segments, partitions and batches; edge inputs."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.operators import order, panel, sampling, series, ticks as tk, txn
from kestrel.sources import fixtures as fx


def same(a, b, digits=9):
    def norm(df):
        return sorted((tuple(float(f"{v:.{digits}g}") if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
    assert norm(a) == norm(b)


# ---- anchored runs -------------------------------------------------------------------------------

def naive_runs(groups, t, window, same_hour):
    out, group, start = [], None, 0
    for g, x in zip(groups, t):
        if g != group or x - start >= window or same_hour and x // 3_600_000_000 != start // 3_600_000_000:
            group, start = g, x
            out.append(False)
        else:
            out.append(True)
    return out


@pytest.mark.parametrize("same_hour", [False, True])
@pytest.mark.parametrize("window_s", [180, 12 * 3600])
def test_runs_over_any_cut_into_batches(same_hour, window_s):
    r = random.Random(window_s + same_hour)
    for _ in range(30):
        rows = sorted((r.randint(0, 2), r.randint(0, 3), r.randint(0, 40) * r.choice([1, 60, 3000]) * 1_000_000) for _ in range(200))
        groups, t = [(a, g) for a, g, _ in rows], [x for *_, x in rows]
        runs, got, at = txn.AnchoredRuns(window_s * 1_000_000, same_hour), [], 0
        while at < len(rows):
            n = r.choice([1, 2, 7, 50])
            part = rows[at:at + n]
            got += runs.mark([np.array([a for a, *_ in part]), np.array([g for _, g, _ in part])],
                             np.array([x for *_, x in part], np.int64)).tolist()
            at += n
        assert got == naive_runs(groups, t, window_s * 1_000_000, same_hour)


def test_multi_swipes_within_an_hour_and_three_minutes(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 58)
    rows = [(i, 1, "m", 5.0, t0 + dt.timedelta(seconds=60 * i)) for i in range(6)] + [(9, 2, "m", 5.0, t0)]
    df = spark.createDataFrame(rows, "row_id long, account long, merchant_category string, amount double, ts timestamp_ntz")
    got = {r.row_id for r in txn.multi_swipes(df, window_s=180, same_hour=True).collect()}
    assert got == {1, 3, 4}  # 0:58-0:59 | 1:00-1:02 | 1:03
    assert {r.row_id for r in txn.multi_swipes(df, window_s=180).collect()} == {1, 2, 4, 5}
    assert txn.multi_swipes(df.limit(0)).count() == 0


# ---- order ----------------------------------------------------------------------------------------

def test_neighbours_across_partitions(spark):
    r = random.Random(1)
    rows = [(i, r.choice("aaaab"), r.randint(0, 30)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, k string, t long").repartition(4)
    for n in (1, 7, 60):
        got = {x.id: (x.id_prev1, x.id_next1, x.id_next2) for x in
               order.with_neighbours(df, "k", ["t", "id"], ["id"], [-1, 1, 2], num_partitions=n).collect()}
        for k in "ab":
            ids = [i for i, kk, t in sorted(rows, key=lambda x: (x[2], x[0])) if kk == k]
            pad = [None, *ids, None, None]
            assert all(got[i] == (pad[j], pad[j + 2], pad[j + 3]) for j, i in enumerate(ids))


@pytest.mark.parametrize("rows, groups, sketch", [(2_000_000, 10_000, 10_000), (20, 10_000, 20), (5, 10_000, 10), (20, 1, 20)])
def test_exact_quantiles(spark, monkeypatch, rows, groups, sketch):
    """Whole groups, brackets, narrowed brackets, and more groups than the driver holds."""
    monkeypatch.setattr(order, "BRACKET_ROWS", rows)
    monkeypatch.setattr(order, "BRACKET_GROUPS", groups)
    monkeypatch.setattr(order, "_SKETCH", sketch)
    r = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": r.choice(["x", "y"], 301), "a": r.integers(0, 20, 301).astype(float), "b": r.normal(size=301)})
    got = {(x.g, x.column): x for x in order.exact_quantiles(spark.createDataFrame(pdf), ["g"], ["a", "b"], [0.0, 0.3, 0.5, 1.0]).collect()}
    for g in "xy":
        for c in "ab":
            want = np.quantile(pdf[pdf.g == g][c], [0, 0.3, 0.5, 1])
            assert np.allclose([got[g, c][f"q{i}"] for i in range(4)], want)


@pytest.mark.parametrize("n", [3, 7, 40, 500])
def test_fold_prefixes(spark, n):
    sizes = [2, 5, 30]
    df = spark.range(n).withColumnRenamed("id", "i")
    got = {}
    for r in sampling.fold_prefixes(df, ["i"], 3, sizes).collect():
        got.setdefault((r.fold, r["size"]), set()).add(r.i)
    edges = np.cumsum([0] + [n // 3 + (f < n % 3) for f in range(3)])
    for f in range(3):
        train = [i for i in range(n) if not edges[f] <= i < edges[f + 1]]
        for s in sizes:
            assert got.get((f, s), set()) == set(train[:s])


# ---- segments ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def split(spark):
    return tk.chrono_split(tk.gap_fill(tk.tick_bins(fx.ticks(spark, SF_SMALL), fx.TICK_BIN_US)))


def test_gap_fill_in_small_segments(spark):
    bins = tk.tick_bins(fx.ticks(spark, SF_SMALL), fx.TICK_BIN_US)
    same(tk.gap_fill(bins, segment=13), tk.gap_fill(bins))


def test_lags_and_folds_in_small_segments(spark, split):
    same(tk.lagged_features(split, segment=301), tk.lagged_features(split))
    keys = ["symbol", "look_back", "horizon", "feature", "fold"]
    a = tk.scan_fold_sums(split, horizons=[10, 20], lookbacks=[10], segment=61).select(*keys, "n", "sxx", "sxy")
    same(a, tk.scan_fold_sums(split, horizons=[10, 20], lookbacks=[10]).select(*keys, "n", "sxx", "sxy"), 7)
    names = ["symbol", "bin", "window", "fold", "P_bid", "Sd_trd", "y"]
    same(tk.smoothed_rows(split, windows=[1, 5], segment=400).select(*names), tk.smoothed_rows(split, windows=[1, 5]).select(*names))


def test_fixed_v_ask_option(split):
    a, b = tk.lagged_features(split, horizons=[10]), tk.lagged_features(split, horizons=[10], fixed_v_ask=True)
    j = a.join(b.select("symbol", "split", "bin", F.col("V_ask").alias("v")), ["symbol", "split", "bin"])
    assert j.count() > 0 and j.where("abs(V_ask - v) > 1e-9").count() > 0


def test_row_number_and_fill_in_segments(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("bin"), F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"))
    same(order.row_number(df, ["g"], ["bin"], dense_col="bin", width=7), order.row_number(df, ["g"], ["bin"]))
    same(series.forward_fill(df, ["g"], "bin", ["v"], segment=7), series.forward_fill(df, ["g"], "bin", ["v"]))


def test_ewm_beta_over_many_blocks(spark):
    """A half-life of 1 makes blocks of 200 rows; 900 rows cross four edges."""
    r = np.random.default_rng(2)
    x, y = r.normal(size=900), r.normal(size=900)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "pos": range(900), "x": x, "y": y})).withColumn("half_life", F.lit(1))
    got = {v.pos: v.beta for v in panel.ewm_beta(df, ["k"], warmup=0).collect()}
    w = 0.5
    s, wx, wy, wxx, wxy = w, 0.0, 0.0, 0.0, 0.0
    for i in range(900):
        if i > 2:
            want = (wxy - wx * wy / s) / (wxx - wx * wx / s)
            assert math.isclose(got[i], want, rel_tol=1e-7, abs_tol=1e-9), i
        s, wx, wy, wxx, wxy = w * (s + 1), w * (wx + x[i]), w * (wy + y[i]), w * (wxx + x[i] ** 2), w * (wxy + x[i] * y[i])


# ---- edge inputs --------------------------------------------------------------------------------------

def test_ticks_empty_and_one_symbol(spark):
    t = fx.ticks(spark, SF_SMALL)
    none = t.where("false")
    assert tk.tick_bins(none, fx.TICK_BIN_US).count() == 0
    assert tk.tick_profile(none).count() == 0
    assert tk.gap_fill(tk.tick_bins(none, fx.TICK_BIN_US)).count() == 0
    one = tk.tick_profile(t.where("symbol = 'STOCKA'")).collect()
    assert [r.symbol for r in one] == ["STOCKA"]


def test_one_busy_bin_is_spread(spark):
    """Raw rows of a bin are never dealt out by the bin alone before they are combined."""
    plan = tk.tick_bins(fx.ticks(spark, SF_SMALL), fx.TICK_BIN_US)._jdf.queryExecution().executedPlan().toString()
    at = [x for x in plan.split("\n") if "Exchange hashpartitioning(" in x]
    assert len(at) == 2 and sum("time#" in x for x in at) == 1 and all("symbol#" in x for x in at)  # all columns, then the partial sums
