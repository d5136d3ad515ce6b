"""Stock-panel queries: market return, alignment, EWM beta, ranking, grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import panel as pn
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import VIEWS


def _mkt_cal(spark, d):
    return pn.market_calendar(pn.market_return(fx.returns_panel(spark, d)))


def _aligned(spark, d):
    return pn.align(fx.returns_panel(spark, d), _mkt_cal(spark, d))


# ---------------------------------------------------------------- SQL


def _w(ctes, body):
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in ctes) + "\n" + body


MKT = ("mkt", "SELECT date, sum(coalesce(weight * ret, 0)) / sum(weight) AS ret_mkt FROM returns_panel GROUP BY date")
CAL = ("cal", "SELECT date, ret_mkt, row_number() OVER (ORDER BY date) AS pos FROM mkt")


def _align_sql(name, panel_cte, cal_cte, value="ret"):
    return (name, f"""
SELECT s.uspn, c.date, s.pos, c.ret_mkt AS x, p.{value} AS y
FROM (SELECT uspn, unnest(range(lo, hi + 1)) AS pos
      FROM (SELECT uspn, min(c.pos) AS lo, max(c.pos) AS hi
            FROM {panel_cte} q JOIN {cal_cte} c ON q.date = c.date GROUP BY uspn)) s
JOIN {cal_cte} c ON s.pos = c.pos
LEFT JOIN (SELECT q.uspn, c.pos, q.{value} FROM {panel_cte} q JOIN {cal_cte} c ON q.date = c.date) p
  ON p.uspn = s.uspn AND p.pos = s.pos""")


def _beta_sql(name, src, keys, hcol="half_life"):
    kl = ", ".join(keys)
    return (name, f"""
SELECT *, CASE WHEN pos >= istart + 200 THEN
              (Wxy - Wx * Wy / S) / NULLIF(Wxx - Wx * Wx / S, 0) END AS beta
FROM (SELECT *, coalesce(sum(e) OVER w, 0) + pow(2.0, -1.0 / {hcol}) AS S,
             coalesce(sum(e * x) OVER w, 0) AS Wx, coalesce(sum(e * y) OVER w, 0) AS Wy,
             coalesce(sum(e * x * x) OVER w, 0) AS Wxx, coalesce(sum(e * x * y) OVER w, 0) AS Wxy
      FROM (SELECT *, pow(2.0, m / {hcol}) AS e
            FROM (SELECT *, row_number() OVER (PARTITION BY {kl} ORDER BY pos) - 1 AS m,
                         min(pos) OVER (PARTITION BY {kl}) AS istart
                  FROM {src} WHERE x IS NOT NULL AND y IS NOT NULL))
      WINDOW w AS (PARTITION BY {kl} ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")


BASE = [("returns_panel", VIEWS["returns_panel"]), MKT, CAL]


def grid_sql():
    parts = []
    ctes = list(BASE)
    for w in pn.WINDOWS:
        ctes.append((f"mk{w}", f"""
SELECT date, pos, CASE WHEN count(ret_mkt) OVER r = {w} THEN avg(ret_mkt) OVER r END AS ret_mkt
FROM cal WINDOW r AS (ORDER BY pos ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"""))
        ctes.append((f"st{w}", f"""
SELECT uspn, date, CASE WHEN count(ret) OVER r = {w} THEN avg(ret) OVER r END AS ret
FROM returns_panel WINDOW r AS (PARTITION BY uspn ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"""))
        ctes.append(_align_sql(f"al{w}", f"st{w}", f"mk{w}"))
        parts.append(f"SELECT *, {w} AS win_size FROM al{w}")
    ctes.append(("aligned", "\nUNION ALL\n".join(parts)))
    hl = " UNION ALL ".join(f"SELECT {h} AS half_life" for h in pn.HALF_LIVES)
    ctes.append(("grid", f"SELECT * FROM aligned CROSS JOIN ({hl})"))
    ctes.append(_beta_sql("b", "grid", ["uspn", "win_size", "half_life"]))
    ctes.append(("r", "SELECT uspn, win_size, half_life, y, x * beta AS yhat FROM b WHERE x * beta IS NOT NULL"))
    body = """
SELECT uspn, win_size, half_life, 1.0 - sum((y - yhat) * (y - yhat)) / NULLIF(sum((y - ybar) * (y - ybar)), 0) AS r2,
       sqrt(sum((y - yhat) * (y - yhat)) / count(*)) AS rmse, avg(abs(y - yhat)) AS mae, count(*) AS n
FROM (SELECT *, avg(y) OVER (PARTITION BY uspn, win_size, half_life) AS ybar FROM r)
GROUP BY uspn, win_size, half_life"""
    return _w(ctes, body)


# ---------------------------------------------------------------- queries


@register("agg_wmean", sql=_w(BASE[:2], "SELECT * FROM mkt"))
def q_wmean(spark, d):
    return pn.market_return(fx.returns_panel(spark, d))


@register("jn_date_align", sql=_w(BASE + [_align_sql("al", "returns_panel", "cal")], "SELECT * FROM al"))
def q_date_align(spark, d):
    return _aligned(spark, d)


@register("win_ewm_beta", sql=_w(BASE + [_align_sql("al", "returns_panel", "cal"),
                                         ("al2", "SELECT *, 120 AS half_life FROM al"),
                                         _beta_sql("b", "al2", ["uspn"])],
                                 "SELECT uspn, date, pos, beta FROM b"))
def q_ewm_beta(spark, d):
    a = _aligned(spark, d).withColumn("half_life", F.lit(120))
    return pn.ewm_beta(a, ["uspn"]).select("uspn", "date", "pos", "beta")


@register("agg_mean_skipnull", sql=_w(BASE + [_align_sql("al", "returns_panel", "cal"),
                                              ("al2", "SELECT *, 120 AS half_life FROM al"),
                                              _beta_sql("b", "al2", ["uspn"])],
                                      "SELECT uspn, avg(beta) AS mean_beta FROM b GROUP BY uspn"))
def q_mean_skipnull(spark, d):
    a = _aligned(spark, d).withColumn("half_life", F.lit(120))
    return pn.ewm_beta(a, ["uspn"]).groupBy("uspn").agg(F.avg("beta").alias("mean_beta"))


@register("win_beta_rank", sql=_w(BASE + [_align_sql("al", "returns_panel", "cal"),
                                          ("al2", "SELECT *, 120 AS half_life FROM al"),
                                          _beta_sql("b", "al2", ["uspn"]),
                                          ("mb", "SELECT uspn, avg(beta) AS mean_beta FROM b GROUP BY uspn")], """
SELECT * FROM (SELECT uspn, mean_beta, 'high' AS side FROM mb ORDER BY mean_beta DESC NULLS LAST, uspn LIMIT 12)
UNION ALL
SELECT * FROM (SELECT uspn, mean_beta, 'low' AS side FROM mb ORDER BY mean_beta ASC NULLS LAST, uspn DESC LIMIT 12)"""))
def q_beta_rank(spark, d):
    return pn.beta_selection(_aligned(spark, d))


@register("win_rolling_mean", sql=_w(BASE[:1], """
SELECT uspn, date, CASE WHEN count(ret) OVER r = 5 THEN avg(ret) OVER r END AS ret_roll
FROM returns_panel WINDOW r AS (PARTITION BY uspn ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""))
def q_rolling_mean(spark, d):
    return pn.rolling_mean(fx.returns_panel(spark, d), ["uspn"], "date", "ret", 5, "ret_roll").select(
        "uspn", "date", "ret_roll")


@register("win_beta_grid", sql=grid_sql())
def q_beta_grid(spark, d):
    return pn.beta_grid(fx.returns_panel(spark, d), _mkt_cal(spark, d))
