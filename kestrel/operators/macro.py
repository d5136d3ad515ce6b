"""Mixed-frequency macro series: differences, frequency alignment, year
profiles, year distance and vector autoregression (SURVEY §2.4/2.5/2.6/2.10).

Series are a long table (series, date, value).  Per-series windows are over a
handful of series with one row per period, so they are small by construction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.order import row_number

# Series that enter in logs, the VAR variable order, base year.
LOG_SERIES = ["GDP", "DGS3MO", "CPIAUCSL"]
LOG_SERIES_YEARLY = ["GDP", "CPIAUCSL"]
VAR_ORDER = ["GDP", "DGS3MO", "DGS10", "BAA10YM", "CPIAUCSL"]
GRID_SERIES = "GDP"
BASE_YEAR = 2001


def _w():
    return Window.partitionBy("series").orderBy("date")


def log_values(df: DataFrame, series: list[str]) -> DataFrame:
    """ln(value) for the listed series (null for values <= 0), others unchanged."""
    return df.withColumn("value", F.when(F.col("series").isin(series), F.ln("value")).otherwise(F.col("value")))


def diff(df: DataFrame) -> DataFrame:
    """First difference per series; the first row is dropped."""
    return (df.withColumn("value", F.col("value") - F.lag("value").over(_w()))
              .where(F.col("value").isNotNull()))


def with_position(df: DataFrame, out: str = "pos") -> DataFrame:
    """0-based position of each row inside its series (date order)."""
    day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
    n = row_number(df.withColumn("_day", day), ["series"], ["_day"], "_rn", dense_col="_day", width=1 << 20)
    return n.withColumn(out, F.col("_rn") - 1).drop("_rn", "_day")


def freq_align(df: DataFrame, grid_series: str = GRID_SERIES) -> DataFrame:
    """Sample every series at proportional positions of the grid series.

    Grid row i of N gets, from a series of n values, the value at
    idx = min(round_half_even(n * i / (N - 1)), n - 1).  Wide output, one row
    per grid point, variables in VAR order.
    """
    pos = with_position(df)
    sizes = df.groupBy("series").agg(F.count(F.lit(1)).alias("_n"))
    grid = pos.where(F.col("series") == grid_series).select(F.col("pos").alias("i"), F.col("date").alias("grid_date"))
    n_grid = F.broadcast(grid.agg(F.count(F.lit(1)).alias("_gridn")))
    want = grid.crossJoin(n_grid).crossJoin(F.broadcast(sizes)).withColumn(
        "pos", F.least(F.bround(F.try_divide(F.col("_n") * F.col("i"), F.col("_gridn") - 1), 0).cast("long"),
                       F.col("_n") - 1))
    picked = want.join(pos.select("series", "pos", "value"), ["series", "pos"])
    return (picked.groupBy("i", "grid_date").pivot("series", VAR_ORDER).agg(F.first("value"))
                  .select("i", "grid_date", *VAR_ORDER))


def var_input(df: DataFrame) -> DataFrame:
    """Aligned grid -> logs of GDP, DGS3MO, CPIAUCSL -> first difference -> drop nulls."""
    wide = freq_align(df)
    logs = wide.select("i", "grid_date", *[(F.ln(c) if c in LOG_SERIES else F.col(c)).alias(c) for c in VAR_ORDER])
    w = Window.partitionBy(F.lit(0)).orderBy("i")  # one row per quarter: a tiny frame
    d = logs.select("i", "grid_date", *[(F.col(c) - F.lag(c).over(w)).alias(c) for c in VAR_ORDER])
    return d.dropna()


def yearly(df: DataFrame) -> DataFrame:
    """Per-series log (GDP, CPI) + difference, then (series, year, pos in year, value)."""
    d = diff(log_values(df, LOG_SERIES_YEARLY))
    d = d.withColumn("year", F.year("date"))
    n = row_number(d.withColumn("_day", F.datediff("date", F.lit("1970-01-01").cast("date"))),
                   ["series", "year"], ["_day"], "_rn", dense_col="_day", width=1 << 20)
    return n.select("series", "year", (F.col("_rn") - 1).alias("pos"), "date", "value")


def year_pairs(yr: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """Each year's value next to the base year's value at the same position."""
    base = yr.where(F.col("year") == base_year).select("series", "pos", F.col("value").alias("base_value"))
    return yr.where(F.col("year") != base_year).join(base, ["series", "pos"])


def year_distance(yr: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """sum over series of sqrt(mean squared gap to the base year); best = smallest.

    The mean divides by the base year's count (positions missing in a year add
    nothing); ``n_series`` reports coverage and only fully covered years
    compete for ``is_best``.
    """
    pairs = year_pairs(yr, base_year)
    bn = yr.where(F.col("year") == base_year).groupBy("series").agg(F.count(F.lit(1)).alias("_nb"))
    per = (pairs.groupBy("series", "year").agg(F.sum((F.col("value") - F.col("base_value")) ** 2).alias("_ss"))
                .join(F.broadcast(bn), "series")
                .withColumn("rmse", F.sqrt(F.col("_ss") / F.col("_nb"))))
    n_all = yr.agg(F.count_distinct("series").alias("_all"))  # one row
    tot = per.groupBy("year").agg(F.sum("rmse").alias("year_sum"), F.count(F.lit(1)).alias("n_series"))
    tot = tot.crossJoin(F.broadcast(n_all)).withColumn("_full", F.col("n_series") == F.col("_all"))
    w = Window.partitionBy("_full").orderBy("year_sum", "year")  # one row per year
    return tot.withColumn("is_best", (F.row_number().over(w) == 1) & F.col("_full")).drop("_all", "_full")


# ---------------------------------------------------------------- VAR

def lagged_design(var_in: DataFrame, p: int, cols=VAR_ORDER) -> DataFrame:
    """Rows t >= p with y_t and lags 1..p of every variable (tiny quarterly table)."""
    w = Window.partitionBy(F.lit(0)).orderBy("i")
    d = var_in.withColumn("_t", F.row_number().over(w) - 1)
    lags = [F.lag(c, k).over(w).alias(f"{c}__l{k}") for k in range(1, p + 1) for c in cols]
    return d.select("_t", *cols, *lags).where(F.col("_t") >= p)


def var_gram(var_in: DataFrame, p: int, cols=VAR_ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """X'X, X'Y, Y'Y and n for the VAR(p) design with a constant (one aggregate)."""
    d = lagged_design(var_in, p, cols)
    xs = [F.lit(1.0)] + [F.col(f"{c}__l{k}") for k in range(1, p + 1) for c in cols]
    ys = [F.col(c) for c in cols]
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(xs[a] * xs[b]).alias(f"xx_{a}_{b}") for a in range(len(xs)) for b in range(a, len(xs))]
    aggs += [F.sum(xs[a] * ys[b]).alias(f"xy_{a}_{b}") for a in range(len(xs)) for b in range(len(ys))]
    aggs += [F.sum(ys[a] * ys[b]).alias(f"yy_{a}_{b}") for a in range(len(ys)) for b in range(a, len(ys))]
    r = d.agg(*aggs).first()
    k, m = len(xs), len(ys)
    xx = np.zeros((k, k)); xy = np.zeros((k, m)); yy = np.zeros((m, m))  # noqa: E702
    for a in range(k):
        for b in range(a, k):
            xx[a, b] = xx[b, a] = r[f"xx_{a}_{b}"] or 0.0
        for b in range(m):
            xy[a, b] = r[f"xy_{a}_{b}"] or 0.0
    for a in range(m):
        for b in range(a, m):
            yy[a, b] = yy[b, a] = r[f"yy_{a}_{b}"] or 0.0
    return xx, xy, yy, int(r["n"] or 0)


def var_fit(var_in: DataFrame, p: int, cols=VAR_ORDER) -> dict:
    """OLS per equation from the Gram sums; ML residual covariance; AIC/BIC/HQC
    (Lütkepohl 2005): ld + c(n) * free, free = K*K*p + K.  ``stderr`` and ``t`` belong to ``coef``:
    residual covariance over n - K*p - 1 degrees of freedom and the inverse of X'X; null matrices (NaN)
    without degrees of freedom."""
    xx, xy, yy, n = var_gram(var_in, p, cols)
    K = len(cols)
    coef = np.linalg.lstsq(xx, xy, rcond=None)[0]
    sse = yy - coef.T @ xy - xy.T @ coef + coef.T @ xx @ coef
    sigma = sse / n
    sign, ld = np.linalg.slogdet(sigma)
    free = K * K * p + K
    rest = n - len(xx)
    spread = np.maximum(np.outer(np.diag(np.linalg.pinv(xx)), np.diag(sse)), 0)
    stderr = np.sqrt(spread / rest) if rest > 0 else np.full(coef.shape, np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = coef / stderr
    return dict(p=p, stderr=stderr, t=t, n=n, coef=coef, sigma=sigma, aic=ld + 2.0 * free / n,
                bic=ld + np.log(n) * free / n, hqic=ld + 2.0 * np.log(np.log(n)) * free / n)


def var_forecast(var_in: DataFrame, fit: dict, steps: int = 2, cols=VAR_ORDER) -> np.ndarray:
    """Iterate the fitted VAR from the last p observations (p rows to the driver)."""
    p = fit["p"]
    last = var_in.orderBy(F.desc("i")).limit(max(p, 1)).select(*cols).collect()
    hist = [np.array([r[c] for c in cols]) for r in reversed(last)]
    out = []
    for _ in range(steps):
        x = [1.0] + [v for k in range(1, p + 1) for v in hist[-k]]
        y = np.array(x) @ fit["coef"]
        out.append(y)
        hist.append(y)
    return np.array(out)
