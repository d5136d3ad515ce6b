"""Order-book queries: profile, bins, gap fill, split, features, ridge scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import linear, ticks as tk
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import VIEWS

W_US, BASE_US = fx.TICK_BIN_US, fx.TICK_BASE_US


# ---------------------------------------------------------------- Spark side

def _filled(spark, d):
    return tk.gap_fill(tk.tick_bins(fx.ticks(spark, d), W_US, BASE_US))


def _split(spark, d):
    return tk.chrono_split(_filled(spark, d))


# ---------------------------------------------------------------- SQL side

def _pct(col: str, shift: int, pct: int) -> str:
    def sh(k):
        if k == 0:
            return col
        fn = "lag" if k > 0 else "lead"
        return f"{fn}({col}, {abs(k)}) OVER w"
    if not pct:
        return sh(shift)
    return f"({sh(shift)} - {sh(shift + pct)}) / NULLIF({sh(shift + pct)}, 0)"


def tick_ctes() -> list[tuple[str, str]]:
    return [
        ("ticks", VIEWS["ticks"]),
        ("tk", "SELECT DISTINCT * FROM ticks"),
        ("tb", f"""
SELECT symbol, bin,
       count(*) FILTER (WHERE trdpx = 0) AS n_quote,
       avg(bid) FILTER (WHERE trdpx = 0) AS q_bid, avg(bidsz) FILTER (WHERE trdpx = 0) AS q_bidsz,
       avg(ask) FILTER (WHERE trdpx = 0) AS q_ask, avg(asksz) FILTER (WHERE trdpx = 0) AS q_asksz,
       count(*) FILTER (WHERE trdpx <> 0) AS n_trade,
       avg(trdpx) FILTER (WHERE trdpx <> 0) AS t_px, avg(trdsz) FILTER (WHERE trdpx <> 0) AS t_sz,
       avg(trdsd) FILTER (WHERE trdpx <> 0) AS t_sd
FROM (SELECT *, CAST(greatest(floor((time - {BASE_US}) / {W_US}), 0) AS BIGINT) AS bin FROM tk)
GROUP BY symbol, bin"""),
        ("cal", """
SELECT symbol, unnest(range(lo, hi + 1)) AS bin
FROM (SELECT symbol, min(bin) AS lo, max(bin) AS hi FROM tb GROUP BY symbol)"""),
        ("jq", """
SELECT *, last_value(q IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY bin
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qf
FROM (SELECT c.symbol, c.bin, tb.n_trade, tb.t_px, tb.t_sz, tb.t_sd,
             CASE WHEN tb.n_quote > 0 THEN {'P_bid': tb.q_bid, 'V_bid': tb.q_bidsz,
                                            'P_ask': tb.q_ask, 'V_ask': tb.q_asksz} END AS q
      FROM cal c LEFT JOIN tb ON c.symbol = tb.symbol AND c.bin = tb.bin)"""),
        ("jt", """
SELECT symbol, bin, qf.P_bid AS P_bid, qf.V_bid AS V_bid, qf.P_ask AS P_ask, qf.V_ask AS V_ask,
       CASE WHEN n_trade IS NULL THEN NULL
            WHEN n_trade > 0 THEN {'P_trd': (t_px - qf.P_bid) / NULLIF(qf.P_ask - qf.P_bid, 0),
                                   'V_trd': t_sz / NULLIF(qf.V_bid + qf.V_ask, 0),
                                   'Sd_trd': round_even(t_sd, 0) + 0.0}
            ELSE {'P_trd': 0.0, 'V_trd': 0.0, 'Sd_trd': 0.0} END AS t
FROM jq"""),
        ("filled", """
SELECT symbol, bin, P_bid, V_bid, P_ask, V_ask, tf.P_trd AS P_trd, tf.V_trd AS V_trd, tf.Sd_trd AS Sd_trd
FROM (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY bin
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tf FROM jt)"""),
        ("sp", """
SELECT f.*, CASE WHEN f.bin - st.first + 1 <= floor(st.n * 0.75) THEN 'train' ELSE 'test' END AS split
FROM filled f JOIN (SELECT symbol, min(bin) AS first, count(*) AS n FROM filled GROUP BY symbol) st
  ON f.symbol = st.symbol"""),
        ("pf", """
SELECT *, (P_ask + P_bid) / 2 AS P_mid, P_ask - P_bid AS P_spread,
       (P_ask - P_bid) / NULLIF((P_ask + P_bid) / 2, 0) AS P_sp_ovr_mid, (V_ask + V_bid) / 2 AS V_mid
FROM sp"""),
    ]


def _with(ctes, body):
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in ctes) + "\n" + body


WINDOW = "WINDOW w AS (PARTITION BY symbol, split ORDER BY bin)"


def feature_ctes() -> list[tuple[str, str]]:
    """CTEs of the feature rows (final CTE: ``feat``)."""
    feats = ", ".join(f"{_pct(s.source, s.shift, s.pct)} AS {s.out}" for s in tk.FEATURE_SPEC)
    ys = ", ".join(f"{_pct(tk.TARGET_SOURCE, -h, tk.TARGET_PCT)} AS y{h}" for h in tk.HORIZONS)
    names = [s.out for s in tk.FEATURE_SPEC]
    wide = f"SELECT symbol, split, bin, {feats}, {ys} FROM pf {WINDOW}"
    parts = []
    for h in tk.HORIZONS:
        parts.append(f"SELECT symbol, split, {h} AS horizon, bin, {', '.join(names)}, y{h} AS target FROM wide")
    nn = " AND ".join(f"{c} IS NOT NULL" for c in names + ["target"])
    body = "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + f") WHERE {nn}"
    return tick_ctes() + [("wide", wide), ("feat", body)]


def _fold_expr(rn="rn", n="n", k=5):
    q, r = f"({n} // {k})", f"({n} % {k})"
    edge = f"({r} * ({q} + 1))"
    return f"CASE WHEN {rn} <= {edge} THEN ({rn} - 1) // ({q} + 1) ELSE {r} + ({rn} - 1 - {edge}) // {q} END"


def ridge_uni_sql(fold_rows_cte: str, keys: list[str], features: list[str], target: str,
                  order: str, alphas=linear.RIDGE_ALPHAS, k: int = 5) -> list[tuple[str, str]]:
    """CTEs computing the univariate ridge CV result from a row CTE (final CTE: ``res``)."""
    kl = ", ".join(keys)
    folded = (f"SELECT *, {_fold_expr(k=k)} AS fold FROM (SELECT *, row_number() OVER "
              f"(PARTITION BY {kl} ORDER BY {order}) AS rn, count(*) OVER (PARTITION BY {kl}) AS n "
              f"FROM {fold_rows_cte})")
    sums = "\nUNION ALL\n".join(
        f"SELECT {kl}, '{x}' AS feature, fold, count(*) AS n, sum({target}) AS sy, "
        f"sum({target} * {target}) AS syy, sum({x} * {x}) AS sxx, sum({x} * {target}) AS sxy "
        f"FROM folded GROUP BY {kl}, fold" for x in features)
    tot = (f"SELECT *, sum(n) OVER p AS Tn, sum(sy) OVER p AS Tsy, sum(syy) OVER p AS Tsyy, "
           f"sum(sxx) OVER p AS Tsxx, sum(sxy) OVER p AS Tsxy FROM sums "
           f"WINDOW p AS (PARTITION BY {kl}, feature)")
    al = " UNION ALL ".join(f"SELECT {i} AS alpha_idx, CAST({a} AS DOUBLE) AS alpha" for i, a in enumerate(alphas))
    cv = f"""
SELECT {kl}, feature, alpha_idx, alpha, avg(r2) AS cv_r2, any_value(Tn) AS Tn, any_value(Tsy) AS Tsy,
       any_value(Tsyy) AS Tsyy, any_value(Tsxx) AS Tsxx, any_value(Tsxy) AS Tsxy
FROM (SELECT *, 1.0 - (syy - 2 * b * sxy + b * b * sxx) / NULLIF(syy - sy * sy / n, 0) AS r2
      FROM (SELECT t.*, a.alpha_idx, a.alpha, (Tsxy - sxy) / NULLIF(Tsxx - sxx + a.alpha, 0) AS b
            FROM tot t CROSS JOIN alphas a))
GROUP BY {kl}, feature, alpha_idx, alpha"""
    res = f"""
SELECT {kl}, feature, alpha AS best_alpha, Tsxy / NULLIF(Tsxx + alpha, 0) AS beta,
       1.0 - (Tsyy - 2 * (Tsxy / NULLIF(Tsxx + alpha, 0)) * Tsxy
              + (Tsxy / NULLIF(Tsxx + alpha, 0)) * (Tsxy / NULLIF(Tsxx + alpha, 0)) * Tsxx)
             / NULLIF(Tsyy - Tsy * Tsy / Tn, 0) AS r2_train,
       Tn AS n_rows
FROM (SELECT *, row_number() OVER (PARTITION BY {kl}, feature ORDER BY cv_r2 DESC NULLS LAST, alpha_idx) AS rk
      FROM cv) WHERE rk = 1"""
    return [("folded", folded), ("sums", sums), ("tot", tot), ("alphas", al), ("cv", cv), ("res", res)]


def scan_sql() -> str:
    cols = []
    for L in tk.SCAN_LOOKBACKS:
        for f in tk.ALL_FEATURES:
            pct = L if f in tk.PRICE_FEATURES else 0
            cols.append(f"{_pct(f, L, pct)} AS {f}__{L}")
        for h in tk.SCAN_HORIZONS:
            cols.append(f"{_pct('P_mid', -h, L)} AS y__{L}__{h}")
    wide = f"SELECT symbol, split, bin, {', '.join(cols)} FROM pf WHERE split = 'train' {WINDOW}"
    parts = []
    for L in tk.SCAN_LOOKBACKS:
        for h in tk.SCAN_HORIZONS:
            fs = ", ".join(f"{f}__{L} AS {f}" for f in tk.ALL_FEATURES)
            parts.append(f"SELECT symbol, {L} AS look_back, {h} AS horizon, bin, {fs}, y__{L}__{h} AS target FROM wide")
    nn = " AND ".join(f"{c} IS NOT NULL" for c in tk.ALL_FEATURES + ["target"])
    rows = "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + f") WHERE {nn}"
    ctes = tick_ctes() + [("wide", wide), ("rows", rows)]
    ctes += ridge_uni_sql("rows", ["symbol", "look_back", "horizon"], tk.ALL_FEATURES, "target", "bin")
    return _with(ctes, "SELECT * FROM res")


# ---------------------------------------------------------------- queries

@register("agg_tick_profile", sql=_with([("ticks", VIEWS["ticks"])], """
SELECT symbol,
       count(*) FILTER (WHERE trdpx = 0) AS num_changes,
       min(bid) FILTER (WHERE trdpx = 0) AS bid_min, max(bid) FILTER (WHERE trdpx = 0) AS bid_max,
       avg(bid) FILTER (WHERE trdpx = 0) AS bid_mean, median(bid) FILTER (WHERE trdpx = 0) AS bid_median,
       stddev_samp(bid) FILTER (WHERE trdpx = 0) AS bid_std, avg(bidsz) FILTER (WHERE trdpx = 0) AS bidsz_mean,
       min(ask) FILTER (WHERE trdpx = 0) AS ask_min, max(ask) FILTER (WHERE trdpx = 0) AS ask_max,
       avg(ask) FILTER (WHERE trdpx = 0) AS ask_mean, median(ask) FILTER (WHERE trdpx = 0) AS ask_median,
       stddev_samp(ask) FILTER (WHERE trdpx = 0) AS ask_std, avg(asksz) FILTER (WHERE trdpx = 0) AS asksz_mean,
       CAST(count(*) FILTER (WHERE trdpx = 0) // 23400 AS BIGINT) AS changes_per_sec,
       count(*) FILTER (WHERE bid = 0) AS num_trades,
       count(*) FILTER (WHERE bid = 0) / 390.0 AS trades_per_min
FROM (SELECT DISTINCT * FROM ticks) GROUP BY symbol"""))
def q_tick_profile(spark, d):
    return tk.tick_profile(fx.ticks(spark, d).dropDuplicates())


@register("dst_full_row", sql=_with([("ticks", VIEWS["ticks"])],
                                    "SELECT DISTINCT * FROM ticks"))
def q_distinct_rows(spark, d):
    return fx.ticks(spark, d).dropDuplicates()


@register("flt_eq_and", sql=_with([("ticks", VIEWS["ticks"])], """
SELECT 'quote' AS kind, symbol, time, bid, ask FROM ticks WHERE symbol = 'STOCKA' AND trdpx = 0
UNION ALL
SELECT 'trade', symbol, time, trdpx, trdsz FROM ticks WHERE symbol = 'STOCKA' AND bid = 0"""))
def q_eq_and(spark, d):
    t = fx.ticks(spark, d)
    a = F.col("symbol") == "STOCKA"
    quotes = t.where(a & (F.col("trdpx") == 0)).select(F.lit("quote").alias("kind"), "symbol", "time", "bid", "ask")
    trades = t.where(a & (F.col("bid") == 0)).select(F.lit("trade").alias("kind"), "symbol", "time",
                                                      F.col("trdpx").alias("bid"), F.col("trdsz").alias("ask"))
    return quotes.unionByName(trades)


@register("flt_trade_pred", sql=_with([("ticks", VIEWS["ticks"])], """
SELECT symbol, count(*) FILTER (WHERE trdpx <> 0) AS n_trade_px, count(*) FILTER (WHERE bid = 0) AS n_trade_bid,
       avg(trdsz) FILTER (WHERE trdpx <> 0) AS mean_trdsz
FROM ticks GROUP BY symbol"""))
def q_trade_pred(spark, d):
    t = fx.ticks(spark, d)
    return t.groupBy("symbol").agg(F.count_if(F.col("trdpx") != 0).alias("n_trade_px"),
                                   F.count_if(F.col("bid") == 0).alias("n_trade_bid"),
                                   F.avg(F.when(F.col("trdpx") != 0, F.col("trdsz"))).alias("mean_trdsz"))


@register("win_tick_bins", sql=_with(tick_ctes()[:3], "SELECT * FROM tb"))
def q_tick_bins(spark, d):
    return tk.tick_bins(fx.ticks(spark, d), W_US, BASE_US)


@register("win_gap_fill", sql=_with(tick_ctes()[:7], "SELECT * FROM filled"))
def q_gap_fill(spark, d):
    return _filled(spark, d)


@register("win_chrono_split", sql=_with(tick_ctes()[:8], "SELECT symbol, bin, split FROM sp"))
def q_chrono_split(spark, d):
    return _split(spark, d).select("symbol", "bin", "split")


@register("set_complement", sql=_with(tick_ctes()[:8], """
SELECT a.symbol, a.bin FROM sp a
WHERE NOT EXISTS (SELECT 1 FROM sp b WHERE b.split = 'train' AND a.symbol = b.symbol AND a.bin = b.bin)"""))
def q_complement(spark, d):
    s = _split(spark, d).select("symbol", "bin", "split")
    train = s.where(F.col("split") == "train").select("symbol", "bin")
    return s.select("symbol", "bin").join(train, ["symbol", "bin"], "left_anti")


@register("fn_mid_spread", sql=_with(tick_ctes(), """
SELECT symbol, bin, P_mid, P_spread, P_sp_ovr_mid, V_mid FROM pf"""))
def q_mid_spread(spark, d):
    return tk.with_point_features(_split(spark, d)).select("symbol", "bin", "P_mid", "P_spread",
                                                           "P_sp_ovr_mid", "V_mid")


@register("win_lag_k", sql=_with(tick_ctes(), f"""
SELECT symbol, bin, lag(P_bid, 10) OVER w AS lag10, lag(P_bid, 120) OVER w AS lag120,
       lead(P_mid, 10) OVER w AS lead10, lead(P_mid, 180) OVER w AS lead180 FROM pf {WINDOW}"""))
def q_lag_k(spark, d):
    base = tk.with_point_features(_split(spark, d))
    specs = [tk.Lagged("lag10", "P_bid", 0, 10), tk.Lagged("lag120", "P_bid", 0, 120),
             tk.Lagged("lead10", "P_mid", 0, -10), tk.Lagged("lead180", "P_mid", 0, -180)]
    h, w = tk._window_parts(base, specs, tk.DEFAULT_SEGMENT)
    return h.select("symbol", "bin", "core", *[tk.lagged_expr(s, w).alias(s.out) for s in specs]).where(
        "core").drop("core")


@register("win_pct_change_k", sql=_with(tick_ctes(), f"""
SELECT symbol, bin, {_pct('P_bid', 0, 90)} AS pct90, {_pct('P_ask', 0, 120)} AS pct120,
       {_pct('P_spread', 0, 40)} AS pct40 FROM pf {WINDOW}"""))
def q_pct_change(spark, d):
    base = tk.with_point_features(_split(spark, d))
    specs = [tk.Lagged("pct90", "P_bid", 90, 0), tk.Lagged("pct120", "P_ask", 120, 0),
             tk.Lagged("pct40", "P_spread", 40, 0)]
    h, w = tk._window_parts(base, specs, tk.DEFAULT_SEGMENT)
    return h.select("symbol", "bin", "core", *[tk.lagged_expr(s, w).alias(s.out) for s in specs]).where(
        "core").drop("core")


@register("win_feature_pipeline", sql=_with(feature_ctes(), "SELECT * FROM feat"))
def q_features(spark, d):
    return tk.lagged_features(_split(spark, d))


@register("win_horizon_scan", sql=scan_sql())
def q_horizon_scan(spark, d):
    return linear.ridge_uni_cv(tk.scan_fold_sums(_split(spark, d)), ["symbol", "look_back", "horizon"])


@register("win_lead_k", sql=_with(tick_ctes(), "SELECT symbol, split, bin, " + ", ".join(
    f"lead(P_mid, {h}) OVER w AS lead{h}" for h in tk.HORIZONS) + f" FROM pf {WINDOW}"))
def q_lead_k(spark, d):
    base = tk.with_point_features(_split(spark, d))
    specs = [tk.Lagged(f"lead{h}", "P_mid", 0, -h) for h in tk.HORIZONS]
    h_df, w = tk._window_parts(base, specs, tk.DEFAULT_SEGMENT)
    return h_df.select("symbol", "split", "bin", "core", *[tk.lagged_expr(s, w).alias(s.out) for s in specs]).where(
        "core").drop("core")


@register("agg_corr_pair", sql=_with(tick_ctes(), """
SELECT a.split, corr(a.P_mid, b.P_mid) AS corr_mid, count(*) AS n
FROM pf a JOIN pf b ON a.bin = b.bin AND a.split = b.split
WHERE a.symbol = 'STOCKA' AND b.symbol = 'STOCKB' GROUP BY a.split"""))
def q_corr_pair(spark, d):
    p = tk.with_point_features(_split(spark, d))
    a = p.where("symbol = 'STOCKA'").select("split", "bin", F.col("P_mid").alias("a"))
    b = p.where("symbol = 'STOCKB'").select("split", "bin", F.col("P_mid").alias("b"))
    return a.join(b, ["split", "bin"]).groupBy("split").agg(F.corr("a", "b").alias("corr_mid"),
                                                            F.count(F.lit(1)).alias("n"))


def smooth_sql() -> str:
    names = [s.out for s in tk.FEATURE_SPEC]
    feats = ", ".join(f"{_pct(s.source, s.shift, s.pct)} AS {s.out}" for s in tk.FEATURE_SPEC)
    y = _pct(tk.TARGET_SOURCE, -tk.SMOOTH_HORIZON, tk.TARGET_PCT)
    lag = f"SELECT symbol, split, bin, {feats}, {y} AS y FROM pf WHERE split = 'train' {WINDOW}"
    parts = []
    for n in tk.SMOOTH_WINDOWS:
        over = f"OVER (PARTITION BY symbol ORDER BY bin ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        cols = ", ".join(f"CASE WHEN count({c}) {over} = {n} THEN avg({c}) {over} END AS {c}" for c in names)
        parts.append(f"SELECT symbol, {n} AS \"window\", y, {cols} FROM lagged")
    nn = " AND ".join(f"{c} IS NOT NULL" for c in [*names, "y"])
    sums = ", ".join(f"sum({c}) AS s_{c}, sum({c} * y) AS sy_{c}" for c in names)
    return _with(tick_ctes() + [("lagged", lag), ("smooth", "\nUNION ALL\n".join(parts))],
                 f"SELECT symbol, \"window\", count(*) AS n, sum(y) AS s_y, {sums} FROM smooth WHERE {nn} GROUP BY 1, 2")


@register("win_smooth_sums", sql=smooth_sql())
def q_smooth_sums(spark, d):
    """Sums over the rows of the smoothing study, per window width."""
    rows = tk.smoothed_rows(_split(spark, d))
    names = [s.out for s in tk.FEATURE_SPEC]
    return rows.groupBy("symbol", "window").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s_y"),
        *[x for c in names for x in (F.sum(c).alias(f"s_{c}"), F.sum(F.col(c) * F.col("y")).alias(f"sy_{c}"))])


@register("win_smooth_scan")
def q_smooth_scan(spark, d):
    """r2 of the 11-feature ridge (alpha by 5-fold search) per symbol and rolling-mean width."""
    names = [s.out for s in tk.FEATURE_SPEC]
    sums = linear.gram_sums(tk.smoothed_rows(_split(spark, d)), ["symbol", "window", "fold"], names, "y").collect()
    folds: dict = {}
    for r in sums:  # symbols x widths x folds
        folds.setdefault((r["symbol"], r["window"]), {})[r["fold"]] = linear.unpack_gram(r, len(names))
    out = []
    for (symbol, width), parts in sorted(folds.items()):
        alpha, beta, _ = linear.ridge_cv_from_folds(parts)
        total = None
        for g in parts.values():
            total = g if total is None else linear.add(total, g)
        out.append((symbol, int(width), float(alpha), linear.r2_from_sums(total, beta)))
    return spark.createDataFrame(out, "symbol string, window int, best_alpha double, r2_train double")
