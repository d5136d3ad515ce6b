"""Profiling queries over the stand-in views."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import clean, profile as pf
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import with_views

REG_COLS = fx.REG_FEATURES + ["label"]
TXN_NUM = ["amount", "available", "balance"]


def _union_sql(cols, select_fn, view):
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS \"column\", {select_fn(f'CAST({c} AS DOUBLE)')} FROM {view}"
                                for c in cols)


@register("agg_describe", sql=with_views(_union_sql(
    REG_COLS, lambda x: f"count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS stddev, "
                        f"min({x}) AS min, max({x}) AS max", "reg_table"), ["reg_table"]))
def q_describe(spark, d):
    return pf.describe(fx.reg_table(spark, d), REG_COLS)


@register("agg_summary_pct", sql=with_views(_union_sql(
    TXN_NUM, lambda x: f"count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS min, "
                       f"quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
                       f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max", "transactions"), ["transactions"]))
def q_summary_pct(spark, d):
    return pf.summary_pct(fx.transactions(spark, d), TXN_NUM)


@register("agg_minmaxmeanmedian", sql=with_views(_union_sql(
    TXN_NUM, lambda x: f"min({x}) AS min, max({x}) AS max, avg({x}) AS mean, median({x}) AS median",
    "transactions"), ["transactions"]))
def q_minmaxmeanmedian(spark, d):
    return pf.min_max_mean_median(fx.transactions(spark, d), TXN_NUM)


NAN_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("agg_null_count", sql=with_views("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM clean" for c in NAN_COLS),
    ["nan_nulls"], [("clean", "SELECT c_custkey, c_name, c_nationkey, CASE WHEN isnan(c_acctbal) THEN NULL "
                              "ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM nan_nulls")]))
def q_null_count(spark, d):
    return pf.null_counts(clean.nan_to_null(fx.nan_nulls(spark, d)))


@register("agg_shape", sql=with_views("SELECT count(*) AS n_rows, 8 AS n_cols FROM transactions",
                                      ["transactions"]))
def q_shape(spark, d):
    return pf.shape(fx.transactions(spark, d))


@register("agg_schema")
def q_schema(spark, d):
    return pf.schema_table(fx.transactions(spark, d))


@register("agg_unique", sql=with_views("SELECT DISTINCT merchant_category AS value FROM transactions",
                                       ["transactions"]))
def q_unique(spark, d):
    return pf.unique_values(fx.transactions(spark, d), "merchant_category")


@register("agg_value_counts", sql=with_views(
    "SELECT merchant_category AS value, count(*) AS count FROM transactions "
    "WHERE merchant_category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1", ["transactions"]))
def q_value_counts(spark, d):
    return pf.value_counts(fx.transactions(spark, d), "merchant_category")


@register("agg_group_size", sql=with_views(
    "SELECT l_returnflag AS value, count(*) AS size FROM reg_table WHERE l_returnflag IS NOT NULL GROUP BY 1",
    ["reg_table"]))
def q_group_size(spark, d):
    return pf.group_size(fx.reg_table(spark, d), "l_returnflag")


@register("agg_month_counter", sql=with_views(
    "SELECT split_part(CAST(ts AS VARCHAR), '-', 2) AS month, count(*) AS count FROM transactions GROUP BY 1",
    ["transactions"]))
def q_month_counter(spark, d):
    return pf.month_counter(fx.transactions(spark, d), "ts")


HIST_SQL = """
SELECT bin, lo + bin * ((hi - lo) / {n}.0) AS "left", lo + (bin + 1) * ((hi - lo) / {n}.0) AS "right", count(*) AS count
FROM (SELECT CAST(coalesce(least(floor((x - lo) / NULLIF(hi - lo, 0) * {n}), {n} - 1), 0) AS BIGINT) AS bin, lo, hi
      FROM (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL) CROSS JOIN
           (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}))
GROUP BY bin, lo, hi"""


@register("agg_hist", sql=with_views(HIST_SQL.format(n=10, col="amount", src="small"), ["transactions"],
                                     [("small", "SELECT * FROM transactions WHERE amount <= 600")]))
def q_hist(spark, d):
    t = fx.transactions(spark, d)
    return pf.histogram(t.where(F.col("amount") <= 600), "amount", 10)


@register("agg_hist_100", sql=with_views(HIST_SQL.format(n=100, col="available", src="transactions"),
                                         ["transactions"]))
def q_hist_100(spark, d):
    return pf.histogram(fx.transactions(spark, d), "available", 100)


@register("agg_nunique_ratio", sql=with_views(
    "SELECT count(DISTINCT account) / count(*) AS ratio FROM transactions", ["transactions"]))
def q_nunique_ratio(spark, d):
    return pf.nunique_ratio(fx.transactions(spark, d), "account")


@register("agg_corr_matrix", sql=with_views("\nUNION ALL\n".join(
    f"SELECT '{REG_COLS[i]}' AS \"row\", '{REG_COLS[j]}' AS col, corr({REG_COLS[i]}, {REG_COLS[j]}) AS corr FROM reg_table"
    for i in range(len(REG_COLS)) for j in range(len(REG_COLS)) if i > j), ["reg_table"]))
def q_corr_matrix(spark, d):
    return pf.corr_matrix(fx.reg_table(spark, d), REG_COLS)
