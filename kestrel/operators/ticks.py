"""Order-book tick data: profile, binning, gap fill, split, lagged features.

Everything stays one lazy plan: ticks -> groupBy(symbol, bin) -> calendar
join + segment-parallel forward fill -> windows over (symbol, split, segment)
with halo rows.  No per-symbol Python loop and no single-task window.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.order import contiguous_fold, exact_quantiles
from kestrel.operators.series import DEFAULT_SEGMENT, forward_fill, with_halo
from kestrel.session import cut_lineage

QUOTE_FEATURES = ["P_bid", "V_bid", "P_ask", "V_ask"]
TRADE_FEATURES = ["P_trd", "V_trd", "Sd_trd"]
BIN_FEATURES = QUOTE_FEATURES + TRADE_FEATURES
ALL_FEATURES = BIN_FEATURES + ["P_mid", "P_spread", "P_sp_ovr_mid", "V_mid"]
PRICE_FEATURES = ["P_bid", "P_ask", "P_mid", "P_spread"]

# Per-session constants of the tick profile (seconds and minutes
# of a 6.5 h trading day).
SECONDS_PER_SESSION = 23400
MINUTES_PER_SESSION = 390


def tick_profile(ticks: DataFrame) -> DataFrame:
    """Per-symbol quote/trade profile: one conditional aggregation, and the medians by
    distributed ranks (a symbol may hold most of the ticks).

    Quotes are ``trdpx = 0`` rows, trades ``bid = 0`` rows (the profile uses
    a different trade predicate from the binning, kept as is).  ``std`` is
    the sample deviation; ``changes_per_sec`` is an integer floor,
    ``trades_per_min`` a true division.
    """
    q = F.col("trdpx") == 0
    t = F.col("bid") == 0

    def qv(c):
        return F.when(q, F.col(c))

    nq = F.count_if(q)
    per = ticks.groupBy("symbol").agg(
        nq.alias("num_changes"),
        F.min(qv("bid")).alias("bid_min"), F.max(qv("bid")).alias("bid_max"),
        F.avg(qv("bid")).alias("bid_mean"),
        F.stddev_samp(qv("bid")).alias("bid_std"), F.avg(qv("bidsz")).alias("bidsz_mean"),
        F.min(qv("ask")).alias("ask_min"), F.max(qv("ask")).alias("ask_max"),
        F.avg(qv("ask")).alias("ask_mean"),
        F.stddev_samp(qv("ask")).alias("ask_std"), F.avg(qv("asksz")).alias("asksz_mean"),
        (nq / SECONDS_PER_SESSION).cast("long").alias("changes_per_sec"),
        F.count_if(t).alias("num_trades"),
        (F.count_if(t) / F.lit(float(MINUTES_PER_SESSION))).alias("trades_per_min"),
    )
    med = exact_quantiles(ticks.where(q), ["symbol"], ["bid", "ask"], [0.5])
    med = med.groupBy("symbol").agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(f"{c}_median")
                                      for c in ("bid", "ask")])
    return per.join(med, "symbol", "left")


def bin_number(time_col: str, width_us: int, base_us: int):
    """Bin index; events before the base fall into bin 0."""
    return F.greatest(F.floor((F.col(time_col) - F.lit(base_us)) / F.lit(width_us)), F.lit(0)).cast("long")


def tick_bins(ticks: DataFrame, width_us: int, base_us: int = 0, dedupe: bool = True) -> DataFrame:
    """Raw per-(symbol, bin) aggregates of the bins that hold events.

    Quote means over ``trdpx = 0`` rows, trade means over ``trdpx <> 0`` rows.
    Exact duplicates are removed by a hash of the whole row, which spreads a busy
    bin over all tasks; the aggregation then has its map-side partial step, so
    a bin never meets in one task as raw rows.
    """
    d = ticks.withColumn("bin", bin_number("time", width_us, base_us))
    if dedupe:
        d = d.dropDuplicates()
    q = F.col("trdpx") == 0
    tr = ~q
    return d.groupBy("symbol", "bin").agg(
        F.count_if(q).alias("n_quote"),
        F.avg(F.when(q, F.col("bid"))).alias("q_bid"),
        F.avg(F.when(q, F.col("bidsz"))).alias("q_bidsz"),
        F.avg(F.when(q, F.col("ask"))).alias("q_ask"),
        F.avg(F.when(q, F.col("asksz"))).alias("q_asksz"),
        F.count_if(tr).alias("n_trade"),
        F.avg(F.when(tr, F.col("trdpx"))).alias("t_px"),
        F.avg(F.when(tr, F.col("trdsz"))).alias("t_sz"),
        F.avg(F.when(tr, F.col("trdsd"))).alias("t_sd"),
    )


def bin_calendar(binned: DataFrame, key: str = "symbol", order: str = "bin",
                 segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """Every bin between a symbol's first and last bin, generated per segment."""
    rng = binned.groupBy(key).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    segs = rng.select(key, "_lo", "_hi",
                      F.explode(F.sequence(F.floor(F.col("_lo") / segment),
                                           F.floor(F.col("_hi") / segment))).alias("_s"))
    return segs.select(key, F.explode(F.sequence(
        F.greatest(F.col("_s") * segment, F.col("_lo")),
        F.least(F.col("_s") * segment + segment - 1, F.col("_hi")))).alias(order))


def gap_fill(binned: DataFrame, compat_relsize: bool = False,
             segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """Seven features per bin, empty bins repeating the previous row.

    * quote features: bin means, else forward-filled from the last quote bin;
    * trade features: from the bin's trade means and the (filled) quote
      features; 0,0,0 when the bin has events but no trade; an empty bin
      repeats the previous bin.  Divisions by zero give null (``try_divide``).
    ``compat_relsize`` divides the trade size by V_bid + P_ask instead of
    V_bid + V_ask.
    """
    cal = bin_calendar(binned, segment=segment)
    d = cal.join(binned, ["symbol", "bin"], "left")
    quote = F.when(F.col("n_quote") > 0, F.struct(
        F.col("q_bid").alias("P_bid"), F.col("q_bidsz").alias("V_bid"),
        F.col("q_ask").alias("P_ask"), F.col("q_asksz").alias("V_ask")))
    d = d.withColumn("_q", quote)
    d = forward_fill(d, ["symbol"], "bin", ["_q"], segment)
    d = d.select("symbol", "bin", "n_trade", "t_px", "t_sz", "t_sd",
                 *[F.col("_q." + c).alias(c) for c in QUOTE_FEATURES])
    denom = (F.col("V_bid") + F.col("P_ask")) if compat_relsize else (F.col("V_bid") + F.col("V_ask"))
    trade = F.when(F.col("n_trade").isNull(), F.lit(None)).when(
        F.col("n_trade") > 0,
        F.struct(F.try_divide(F.col("t_px") - F.col("P_bid"), F.col("P_ask") - F.col("P_bid")).alias("P_trd"),
                 F.try_divide(F.col("t_sz"), denom).alias("V_trd"),
                 F.bround(F.col("t_sd"), 0).alias("Sd_trd"))
    ).otherwise(F.struct(F.lit(0.0).alias("P_trd"), F.lit(0.0).alias("V_trd"), F.lit(0.0).alias("Sd_trd")))
    d = d.withColumn("_t", trade)
    d = forward_fill(d, ["symbol"], "bin", ["_t"], segment)
    return d.select("symbol", "bin", *QUOTE_FEATURES, *[F.col("_t." + c).alias(c) for c in TRADE_FEATURES])


def chrono_split(filled: DataFrame, train_frac: float = 0.75) -> DataFrame:
    """First ``floor(frac * n)`` bins of each symbol are 'train', the rest 'test'.

    Bins are contiguous after ``gap_fill``, so the row number is ``bin - first + 1``
    and no window is needed.
    """
    st = filled.groupBy("symbol").agg(F.min("bin").alias("_first"), F.count(F.lit(1)).alias("_n"))
    rn = F.col("bin") - F.col("_first") + 1
    split = F.when(rn <= F.floor(F.col("_n") * F.lit(train_frac)), F.lit("train")).otherwise(F.lit("test"))
    return filled.join(st, "symbol").select(*filled.columns, split.alias("split"))


def with_point_features(df: DataFrame) -> DataFrame:
    """Mid, spread, spread over mid and mean size (raw, before any shift)."""
    return df.withColumns({
        "P_mid": (F.col("P_ask") + F.col("P_bid")) / 2,
        "P_spread": F.col("P_ask") - F.col("P_bid"),
        "P_sp_ovr_mid": F.try_divide(F.col("P_ask") - F.col("P_bid"), (F.col("P_ask") + F.col("P_bid")) / 2),
        "V_mid": (F.col("V_ask") + F.col("V_bid")) / 2})


@dataclass(frozen=True)
class Lagged:
    """``out`` = pct_change(``source``, ``pct``) shifted by ``shift`` rows (negative = lead)."""
    out: str
    source: str
    pct: int = 0
    shift: int = 0


# The published feature set (percent-change look-back, then
# shift) and the target.  V_ask is the shifted percent change of P_ask, shifted
# again by 10; P_sp_ovr_mid is the raw ratio.
FEATURE_SPEC = [
    Lagged("P_bid", "P_bid", 90, 90),
    Lagged("V_bid", "V_bid", 0, 90),
    Lagged("P_ask", "P_ask", 120, 120),
    Lagged("V_ask", "P_ask", 120, 130),
    Lagged("P_trd", "P_trd", 0, 10),
    Lagged("V_trd", "V_trd", 0, 10),
    Lagged("Sd_trd", "Sd_trd", 0, 10),
    Lagged("P_mid", "P_mid", 120, 120),
    Lagged("P_spread", "P_spread", 40, 40),
    Lagged("P_sp_ovr_mid", "P_sp_ovr_mid", 0, 40),
    Lagged("V_mid", "V_mid", 0, 60),
]
FEATURE_SPEC_FIXED_V_ASK = [s if s.out != "V_ask" else Lagged("V_ask", "V_ask", 0, 10) for s in FEATURE_SPEC]
TARGET_SOURCE, TARGET_PCT = "P_mid", 120
HORIZONS = [10, 20, 30, 60, 120, 180]


def shifted(col: str, k: int, w: Window):
    if k == 0:
        return F.col(col)
    return F.lag(col, k).over(w) if k > 0 else F.lead(col, -k).over(w)


def lagged_expr(spec: Lagged, w: Window):
    """Value of ``spec`` at the current row, as lags of the source column only."""
    now = shifted(spec.source, spec.shift, w)
    if not spec.pct:
        return now
    before = shifted(spec.source, spec.shift + spec.pct, w)
    return F.try_divide(now - before, before)


def _window_parts(df: DataFrame, specs: list[Lagged], segment: int) -> tuple[DataFrame, Window]:
    back = max([s.shift + s.pct for s in specs if s.shift + s.pct > 0] + [0])
    fwd = max([-s.shift for s in specs if s.shift < 0] + [0])
    h = with_halo(df, "bin", back, fwd, segment)
    w = Window.partitionBy("symbol", "split", "_seg").orderBy("bin")
    return h, w


def lagged_features(split_df: DataFrame, horizons=HORIZONS, spec=None, fixed_v_ask: bool = False,
                    segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """Feature rows per (symbol, split, horizon, bin), nulls dropped.

    All lags of all horizons come from ONE window spec over
    (symbol, split, segment); the split is part of the partition, so no lag
    crosses the train/test boundary.  ``fixed_v_ask`` takes V_ask from the ask size
    instead of the published double shift of the ask price.
    """
    spec = spec or (FEATURE_SPEC_FIXED_V_ASK if fixed_v_ask else FEATURE_SPEC)
    base = with_point_features(split_df)
    targets = [Lagged(f"_y{h}", TARGET_SOURCE, TARGET_PCT, -h) for h in horizons]
    h_df, w = _window_parts(base, list(spec) + targets, segment)
    cols = [lagged_expr(s, w).alias(s.out) for s in spec] + [lagged_expr(t, w).alias(t.out) for t in targets]
    wide = h_df.select("symbol", "split", "bin", "core", *cols).where("core")
    names = [s.out for s in spec]
    per_h = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"_y{h}").alias("target"))
                                for h in horizons]))
    long = wide.select("symbol", "split", "bin", *names, per_h.alias("_h"))
    out = long.select("symbol", "split", F.col("_h.horizon").alias("horizon"), "bin", *names,
                      F.col("_h.target").alias("target"))
    return out.dropna(subset=names + ["target"])


# The horizon/look-back study grid.
SCAN_HORIZONS = [10, 20, 40, 60, 90]
SCAN_LOOKBACKS = [10, 20, 40, 60, 90, 120]


def folded_cells(wide: DataFrame, w: Window, cells: list[tuple[dict, dict]], k: int) -> DataFrame:
    """Valid rows of every cell of a grid over wide rows, each with its contiguous fold.

    A cell is (its parameters, {output: column of ``wide``}); a row is valid in it if
    none of these columns is null.  Running counts of valid rows, in the window that
    made the columns plus per-segment offsets, number the rows of each cell; the cells
    of a row are laid out last, so an aggregate on top combines them before any shuffle.
    The wide columns are computed twice, for the offsets and for the rows, and never written:
    ``wide`` should stand on a narrow table that is cheap to read again.
    """
    def valid(cols):
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols.values()])
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    ends = wide.groupBy("symbol", "_seg").agg(*[F.count_if(valid(cols)).alias(f"_c{i}") for i, (_, cols) in enumerate(cells)])
    wide = wide.select("*", *[F.count_if(valid(cols)).over(so_far).alias(f"_rn{i}") for i, (_, cols) in enumerate(cells)])
    whole = Window.partitionBy("symbol")
    before = whole.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("symbol", "_seg", *[x for i in range(len(cells)) for x in (
        F.coalesce(F.sum(f"_c{i}").over(before), F.lit(0)).alias(f"_off{i}"), F.sum(f"_c{i}").over(whole).alias(f"_n{i}"))])
    j = wide.join(ends, ["symbol", "_seg"])
    rows = [F.when(valid(cols), F.struct(
        *[F.lit(v).alias(n) for n, v in ids.items()],
        contiguous_fold(F.col(f"_off{i}") + F.col(f"_rn{i}"), F.col(f"_n{i}"), k).alias("fold"),
        *[F.col(c).alias(out) for out, c in cols.items()])) for i, (ids, cols) in enumerate(cells)]
    return j.select("symbol", "bin", F.explode(F.array(*rows)).alias("c")).where("c IS NOT NULL").select("symbol", "bin", "c.*")


# Rolling-mean widths (rows) and the prediction horizon of the smoothing study.
SMOOTH_WINDOWS = [1, 3, 5, 8, 12, 18]
SMOOTH_HORIZON = 60


def smoothed_rows(split_df: DataFrame, windows=SMOOTH_WINDOWS, horizon: int = SMOOTH_HORIZON, spec=FEATURE_SPEC,
                  k: int = 5, split: str = "train", segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """(symbol, bin, window, fold, features, y): the published features, each the mean of the last
    ``window`` rows (null unless all are there), against the unsmoothed target."""
    base = with_point_features(split_df.where(F.col("split") == split))
    y = Lagged("y", TARGET_SOURCE, TARGET_PCT, -horizon)
    reach = max(s.shift + s.pct for s in spec) + max(windows)
    h_df, w = _window_parts(base, [*spec, y, Lagged("_reach", "P_bid", 0, reach)], segment)
    wide = cut_lineage(h_df).select("symbol", "split", "_seg", "bin", "core", *[lagged_expr(s, w).alias(s.out) for s in [*spec, y]])
    names = [s.out for s in spec]

    def mean(c, n):
        last = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(c).over(last) == n, F.avg(c).over(last)).alias(f"{c}__{n}")
    wide = wide.select("symbol", "split", "_seg", "bin", "core", "y", *[mean(c, n) for n in windows for c in names])
    cells = [({"window": n}, {c: f"{c}__{n}" for c in names} | {"y": "y"}) for n in windows]
    return folded_cells(wide.where("core").drop("core"), w, cells, k)


def scan_fold_sums(split_df: DataFrame, horizons=SCAN_HORIZONS, lookbacks=SCAN_LOOKBACKS, k: int = 5,
                   split: str = "train", segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """Sums of every (symbol, look_back, horizon, feature, fold) cell of the scan.

    For look-back L: price features are pct_change(L) then every feature is
    shifted by L; target = pct_change(P_mid, L) led by the horizon.  Rows of a cell
    with any null are left out (as the whole-frame dropna does), and the rest form k
    contiguous folds.

    A bin stays one wide row: running counts of its valid cells, in the window of
    the lags, give its fold in every cell.  Only then are cells laid out as
    rows, straight into a partial aggregate, so none of them is shuffled.
    """
    base = with_point_features(split_df.where(F.col("split") == split))
    specs: dict[str, Lagged] = {}
    for L in lookbacks:
        for f in ALL_FEATURES:
            pct = L if f in PRICE_FEATURES else 0
            specs[f"{f}__{L}"] = Lagged(f"{f}__{L}", f, pct, L)
        for hz in horizons:
            specs[f"_y__{L}__{hz}"] = Lagged(f"_y__{L}__{hz}", "P_mid", L, -hz)
    h_df, w = _window_parts(base, list(specs.values()), segment)
    wide = cut_lineage(h_df).select("symbol", "split", "_seg", "bin", "core", *[
        lagged_expr(s, w).alias(n) for n, s in specs.items()]).where("core").drop("core")
    cells = [({"look_back": L, "horizon": hz}, {f: f"{f}__{L}" for f in ALL_FEATURES} | {"y": f"_y__{L}__{hz}"})
             for L in lookbacks for hz in horizons]
    long = folded_cells(wide, w, cells, k)
    y = F.col("y")
    sums = long.groupBy("symbol", "look_back", "horizon", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"),
        *[F.sum(F.col(f) * F.col(f)).alias(f"xx__{f}") for f in ALL_FEATURES],
        *[F.sum(F.col(f) * y).alias(f"xy__{f}") for f in ALL_FEATURES])
    per = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"xx__{f}").alias("sxx"),
                                      F.col(f"xy__{f}").alias("sxy")) for f in ALL_FEATURES]))
    return sums.select("symbol", "look_back", "horizon", "fold", "n", "sy", "syy", per)
