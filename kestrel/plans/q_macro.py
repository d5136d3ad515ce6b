"""Macro-series queries: differences, alignment, year profiles, VAR."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import macro as mc
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import VIEWS


def _w(ctes, body):
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in ctes) + "\n" + body


MS = ("macro_series", VIEWS["macro_series"])
VARS = mc.VAR_ORDER


def _ln(x):
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


ALIGN = [
    MS,
    ("pos", "SELECT series, date, value, row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS pos "
            "FROM macro_series"),
    ("sizes", "SELECT series, count(*) AS n FROM macro_series GROUP BY series"),
    ("grid", f"SELECT pos AS i, date AS grid_date FROM pos WHERE series = '{mc.GRID_SERIES}'"),
    ("nn", "SELECT count(*) AS big_n FROM grid"),
    ("want", "SELECT g.i, g.grid_date, s.series, least(CAST(round_even(s.n * g.i / (nn.big_n - 1), 0) AS BIGINT), "
             "s.n - 1) AS pos FROM grid g CROSS JOIN nn CROSS JOIN sizes s"),
    ("aligned", "SELECT w.i, w.grid_date, " + ", ".join(
        f"max(p.value) FILTER (WHERE w.series = '{v}') AS {v}" for v in VARS)
     + " FROM want w JOIN pos p ON w.series = p.series AND w.pos = p.pos GROUP BY w.i, w.grid_date"),
]

VAR_IN = ALIGN + [
    ("logs", "SELECT i, grid_date, " + ", ".join((f"{_ln(v)} AS {v}" if v in mc.LOG_SERIES else v) for v in VARS)
     + " FROM aligned"),
    ("dif", "SELECT i, grid_date, " + ", ".join(f"{v} - lag({v}) OVER (ORDER BY i) AS {v}" for v in VARS)
     + " FROM logs"),
    ("var_in", "SELECT * FROM dif WHERE " + " AND ".join(f"{v} IS NOT NULL" for v in VARS)),
]

YEARLY = [
    MS,
    ("lv", "SELECT series, date, CASE WHEN series IN ('GDP', 'CPIAUCSL') THEN " + _ln("value")
           + " ELSE value END AS value FROM macro_series"),
    ("df", "SELECT series, date, value - lag(value) OVER (PARTITION BY series ORDER BY date) AS value FROM lv"),
    ("yr", "SELECT series, CAST(year(date) AS INTEGER) AS year, row_number() OVER (PARTITION BY series, year(date) "
           "ORDER BY date) - 1 AS pos, date, value FROM df WHERE value IS NOT NULL"),
    ("base", f"SELECT series, pos, value AS base_value FROM yr WHERE year = {mc.BASE_YEAR}"),
    ("pairs", f"SELECT y.*, b.base_value FROM yr y JOIN base b ON y.series = b.series AND y.pos = b.pos "
              f"WHERE y.year <> {mc.BASE_YEAR}"),
]


@register("win_log_diff", sql=_w([MS], f"""
SELECT series, date, value FROM (
  SELECT series, date, {_ln('value')} - lag({_ln('value')}) OVER (PARTITION BY series ORDER BY date) AS value
  FROM macro_series) WHERE value IS NOT NULL"""))
def q_log_diff(spark, d):
    m = fx.macro_series(spark, d)
    return mc.diff(mc.log_values(m, mc.VAR_ORDER))


@register("win_diff", sql=_w([MS], """
SELECT series, date, value FROM (
  SELECT series, date, value - lag(value) OVER (PARTITION BY series ORDER BY date) AS value FROM macro_series)
WHERE value IS NOT NULL"""))
def q_diff(spark, d):
    return mc.diff(fx.macro_series(spark, d))


@register("jn_freq_align", sql=_w(ALIGN, "SELECT * FROM aligned"))
def q_freq_align(spark, d):
    return mc.freq_align(fx.macro_series(spark, d))


@register("mdl_var_input", sql=_w(VAR_IN, "SELECT * FROM var_in"))
def q_var_input(spark, d):
    return mc.var_input(fx.macro_series(spark, d))


@register("win_year_groups", sql=_w(YEARLY[:4], "SELECT * FROM yr"))
def q_year_groups(spark, d):
    return mc.yearly(fx.macro_series(spark, d))


@register("jn_year_pos", sql=_w(YEARLY, "SELECT * FROM pairs"))
def q_year_pos(spark, d):
    return mc.year_pairs(mc.yearly(fx.macro_series(spark, d)))


@register("agg_year_rmse", sql=_w(YEARLY + [
    ("bn", "SELECT series, count(*) AS nb FROM base GROUP BY series"),
    ("per", "SELECT p.series, p.year, sqrt(sum((p.value - p.base_value) * (p.value - p.base_value)) / "
            "any_value(bn.nb)) AS rmse FROM pairs p JOIN bn ON p.series = bn.series GROUP BY p.series, p.year"),
    ("tot", "SELECT year, sum(rmse) AS year_sum, count(*) AS n_series FROM per GROUP BY year"),
    ("nall", "SELECT count(DISTINCT series) AS n FROM yr")], """
SELECT year, year_sum, n_series,
       (row_number() OVER (PARTITION BY n_series = nall.n ORDER BY year_sum, year) = 1) AND n_series = nall.n AS is_best
FROM tot CROSS JOIN nall"""))
def q_year_rmse(spark, d):
    return mc.year_distance(mc.yearly(fx.macro_series(spark, d)))


@register("mdl_var_sums", sql=_w(VAR_IN + [
    ("des", "SELECT " + ", ".join(VARS) + ", " + ", ".join(f"lag({v}) OVER (ORDER BY i) AS {v}__l1" for v in VARS)
     + ", row_number() OVER (ORDER BY i) - 1 AS t FROM var_in")],
    "SELECT count(*) AS n, " + ", ".join(f"sum({a}__l1 * {b}) AS xy_{a}_{b}" for a in VARS for b in VARS)
    + ", " + ", ".join(f"sum({a}__l1) AS x_{a}" for a in VARS) + " FROM des WHERE t >= 1"))
def q_var_sums(spark, d):
    des = mc.lagged_design(mc.var_input(fx.macro_series(spark, d)), 1)
    return des.agg(F.count(F.lit(1)).alias("n"),
                   *[F.sum(F.col(f"{a}__l1") * F.col(b)).alias(f"xy_{a}_{b}") for a in VARS for b in VARS],
                   *[F.sum(f"{a}__l1").alias(f"x_{a}") for a in VARS])


@register("mdl_var")
def q_var(spark, d):
    """Lag-order table (AIC/BIC/HQC, p = 0..10; an order with more coefficients than the sample
    carries is listed as such) + 2-step forecast of the VAR(3) fit, its coefficients, their standard errors
    and t values, from Gram sums (small matrices) solved on the driver."""
    vin = mc.var_input(fx.macro_series(spark, d)).cache()
    n_rows = vin.count()
    K = len(VARS)
    rows = []
    for p in range(11):
        if n_rows - p <= K * p + 1:
            rows.append(("order_too_long_for_sample", p, n_rows - p, None, None, None, None))
            continue
        f = mc.var_fit(vin, p)
        rows.append(("order", p, int(f["n"]), float(f["aic"]), float(f["bic"]), float(f["hqic"]), None))
    if n_rows - 3 > K * 3 + 1:
        fit = mc.var_fit(vin, 3)
        for s, vec in enumerate(mc.var_forecast(vin, fit, 2), start=1):
            for name, v in zip(VARS, vec):
                rows.append((f"forecast_{name}", 3, s, None, None, None, float(v)))
        for i, line in enumerate(fit["coef"]):
            for name, v in zip(VARS, line):
                rows.append((f"coef_{name}", 3, i, None, None, None, float(v)))
        for kind in ("stderr", "t"):
            for i, line in enumerate(fit[kind]):
                rows += [(f"{kind}_{name}", 3, i, None, None, None, float(v) if np.isfinite(v) else None) for name, v in zip(VARS, line)]
    else:
        rows.append(("forecast_too_short_sample", 3, n_rows, None, None, None, None))
    vin.unpersist()
    return spark.createDataFrame(rows, "kind string, p int, n int, aic double, bic double, hqic double, "
                                       "value double")
