"""Stock panel: market return, calendar alignment, exponentially weighted beta,
rolling means and the beta parameter grid (SURVEY §2.5/2.6)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.order import row_number
from kestrel.operators.profile import weighted_mean

# Beta warm-up length and the study grid.
WARMUP_ROWS = 200
HALF_LIVES = [30, 60, 90, 120, 180]
WINDOWS = [1, 5, 15, 30]
SELECT_HALF_LIFE = 120
SELECT_TOP = 12


def market_return(panel: DataFrame) -> DataFrame:
    """(date, ret_mkt) = sum(w*r)/sum(w) per date; a null return keeps its weight."""
    return weighted_mean(panel, ["date"], "weight", "ret", "ret_mkt")


def market_calendar(mkt: DataFrame) -> DataFrame:
    """Market dates with their position (1-based).  One row per trading date, so
    the single ordered pass is over the calendar, not over the data."""
    day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
    return row_number(mkt.withColumn("_day", day), [], ["_day"], "pos", dense_col="_day",
                      width=1 << 20).drop("_day")


def align(panel: DataFrame, mkt_cal: DataFrame, value: str = "ret") -> DataFrame:
    """Each stock on the market calendar between its first and last date.

    x = market return, y = stock value (null where the stock has no row);
    equi-join on date, no positional matching.
    """
    p = panel.join(mkt_cal.select("date", "pos"), "date")
    span = p.groupBy("uspn").agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    cal = span.select("uspn", F.explode(F.sequence("_lo", "_hi")).alias("pos"))
    return (cal.join(mkt_cal, "pos")
               .join(p.select("uspn", "pos", F.col(value).alias("y")), ["uspn", "pos"], "left")
               .select("uspn", "date", "pos", F.col("ret_mkt").alias("x"), "y"))


def rolling_mean(df: DataFrame, keys: list[str], order_col: str, col: str, w: int, out: str) -> DataFrame:
    """Trailing mean of ``w`` rows, null unless all ``w`` values are present."""
    win = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(-(w - 1), 0)
    return df.withColumn(out, F.when(F.count(col).over(win) == w, F.avg(col).over(win)))


def ewm_beta(aligned: DataFrame, keys: list[str], half_life_col: str = "half_life",
             warmup: int = WARMUP_ROWS) -> DataFrame:
    """Exponentially weighted regression slope of y on x from EARLIER rows only.

    With decay d = 2^(-1/h) and m the index of the current valid row among the
    valid (x, y non-null) rows, the running sums of the reference loop are

        S = d^(m+1) + sum_{j<m} d^(m-j),   Wx = sum_{j<m} d^(m-j) x_j,  ...

    and beta = (Wxy - Wx Wy / S) / (Wxx - Wx^2 / S) is invariant under a common
    scale, so weights 2^(j/h) are used.  To keep them finite on long series the
    valid rows are cut into blocks of L = 200 h rows: sums inside a block use
    2^((j - bL)/h) (a window over (key, block)), and the two previous blocks'
    totals are carried in with factors 2^(-L/h), 2^(-2L/h) (older blocks weigh
    below 2^-400, far under the last bit of a double).  Nulls are skipped without decay; beta is null before
    position istart + warmup (positions count null rows), as in the loop.
    """
    valid = aligned.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    m = row_number(valid, keys, ["pos"], "_m", dense_col="pos", width=1 << 20)
    h = F.col(half_life_col).cast("double")
    blk_len = F.greatest(F.lit(1), (F.lit(200.0) * h).cast("long"))
    m = m.withColumn("_m", F.col("_m") - 1).withColumn("_L", blk_len)
    m = m.withColumn("_b", (F.col("_m") / F.col("_L")).cast("long"))
    e = F.pow(F.lit(2.0), (F.col("_m") - F.col("_b") * F.col("_L")) / h)
    terms = {"1": e, "x": e * F.col("x"), "y": e * F.col("y"), "xx": e * F.col("x") * F.col("x"),
             "xy": e * F.col("x") * F.col("y")}
    m = m.withColumns({f"_e{k}": v for k, v in terms.items()})
    wb = Window.partitionBy(*keys, "_b").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumns({f"_p{k}": F.coalesce(F.sum(f"_e{k}").over(wb), F.lit(0.0)) for k in terms})
    tot = m.groupBy(*keys, "_b").agg(F.first("_L").alias("_L"), F.first(half_life_col).alias("_h"),
                                     F.min("pos").alias("_pos"),
                                     *[F.sum(f"_e{k}").alias(f"_t{k}") for k in terms])
    wl = Window.partitionBy(*keys).orderBy("_b")
    f1 = F.pow(F.lit(2.0), -F.col("_L") / F.col("_h"))
    carry = tot.select(*keys, "_b", F.min("_pos").over(Window.partitionBy(*keys)).alias("_istart"), *[
        (F.coalesce(F.lag(f"_t{k}", 1).over(wl) * f1, F.lit(0.0))
         + F.coalesce(F.lag(f"_t{k}", 2).over(wl) * f1 * f1, F.lit(0.0))).alias(f"_c{k}") for k in terms])
    j = m.join(carry, [*keys, "_b"])
    s0 = F.pow(F.lit(2.0), (F.lit(-1.0) - F.col("_b") * F.col("_L")) / h)
    W = {k: F.col(f"_p{k}") + F.col(f"_c{k}") for k in terms}
    S = W["1"] + s0
    num = W["xy"] - W["x"] * W["y"] / S
    den = W["xx"] - W["x"] * W["x"] / S
    j = j.withColumn(
        "beta", F.when(F.col("pos") >= F.col("_istart") + warmup, F.try_divide(num, den)))
    drop = [c for c in j.columns if c.startswith("_")]
    return j.drop(*drop)


def beta_selection(aligned: DataFrame, half_life: int = SELECT_HALF_LIFE, top: int = SELECT_TOP,
                   by_abs: bool = False) -> DataFrame:
    """Mean beta per stock (nulls skipped); the ``top`` highest and lowest."""
    b = ewm_beta(aligned.withColumn("half_life", F.lit(half_life)), ["uspn"])
    mean = b.groupBy("uspn").agg(F.avg("beta").alias("mean_beta"))
    key = F.abs("mean_beta") if by_abs else F.col("mean_beta")
    hi = mean.orderBy(key.desc_nulls_last(), "uspn").limit(top).withColumn("side", F.lit("high"))
    lo = mean.orderBy(key.asc_nulls_last(), F.desc("uspn")).limit(top).withColumn("side", F.lit("low"))
    return hi.unionByName(lo)


def beta_grid(panel: DataFrame, mkt_cal: DataFrame, windows=WINDOWS, half_lives=HALF_LIVES) -> DataFrame:
    """r2 / rmse / mae of y_hat = rolling market * beta per (stock, window, half-life).

    The (window, half-life) grid is a small table joined to the data; each
    window size needs its own rolling frame, so windows are unioned (4 frames)
    and half-lives ride along as a key of the beta windows.
    """
    spark = panel.sparkSession
    # all rolling frames in one pass per side, one alignment, then one row per window size
    mk = mkt_cal.withColumn("_k", F.lit(0))
    for w in windows:
        mk = rolling_mean(mk, ["_k"], "pos", "ret_mkt", w, f"_xr{w}")  # one row per date: small
    st = panel.select("uspn", "date", "ret")
    for w in windows:
        st = rolling_mean(st, ["uspn"], "date", "ret", w, f"_yr{w}")
    p = st.join(mkt_cal.select("date", "pos"), "date")
    span = p.groupBy("uspn").agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    cal = span.select("uspn", F.explode(F.sequence("_lo", "_hi")).alias("pos"))
    wide = (cal.join(mk.drop("_k", "ret_mkt"), "pos")
               .join(p.select("uspn", "pos", *[f"_yr{w}" for w in windows]), ["uspn", "pos"], "left"))
    cells = F.array(*[F.struct(F.lit(w).alias("win_size"), F.col(f"_xr{w}").alias("x"), F.col(f"_yr{w}").alias("y"))
                      for w in windows])
    aligned = wide.select("uspn", "date", "pos", F.inline(cells))
    hl = spark.createDataFrame([(h,) for h in half_lives], "half_life int")
    grid = aligned.crossJoin(F.broadcast(hl))
    keys = ["uspn", "win_size", "half_life"]
    b = ewm_beta(grid, keys)
    r = b.withColumn("yhat", F.col("x") * F.col("beta")).where(F.col("yhat").isNotNull() & F.col("y").isNotNull())
    out = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                               (F.var_pop("y") * F.count(F.lit(1))).alias("sstot"),
                               F.sum((F.col("y") - F.col("yhat")) ** 2).alias("ssres"),
                               F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"))
    return out.select(*keys, (F.lit(1.0) - F.try_divide(F.col("ssres"), F.col("sstot"))).alias("r2"),
                      F.sqrt(F.col("ssres") / F.col("n")).alias("rmse"), "mae", "n")


def decay(half_life: float) -> float:
    return math.pow(2.0, -1.0 / half_life)
