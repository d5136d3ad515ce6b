"""Metric queries over the `scores` and `reg_table` views."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import metrics as mt
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import with_views


def _pred(s):
    return s.withColumn("pred", F.when(F.col("p1") > F.lit(1.0) - F.col("p1"), 1).otherwise(0))


PRED = ("sp", "SELECT *, CASE WHEN p1 > 1.0 - p1 THEN 1 ELSE 0 END AS pred FROM scores")
ROC = [("g", "SELECT p1 AS threshold, count(*) FILTER (WHERE target = 1) AS tp, "
             "count(*) FILTER (WHERE target <> 1) AS fp FROM scores GROUP BY p1"),
       ("c", "SELECT *, sum(tp) OVER w AS tp_cum, sum(fp) OVER w AS fp_cum FROM g "
             "WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
       ("tot", "SELECT sum(tp) AS P, sum(fp) AS N FROM g")]

CLS_SQL = """
SELECT n, coalesce(ok / n, 0) AS accuracy,
       coalesce(tp / NULLIF(tp + fp, 0), 0) AS precision, coalesce(tp / NULLIF(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1{extra}
FROM (SELECT {keys} count(*) AS n, CAST(count(*) FILTER (WHERE target = pred) AS DOUBLE) AS ok,
             CAST(count(*) FILTER (WHERE target = 1 AND pred = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE target <> 1 AND pred = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE target = 1 AND pred <> 1) AS DOUBLE) AS fn
      FROM sp {group})"""


@register("met_regression", sql=with_views("""
SELECT count(*) AS n, avg((label - yhat) * (label - yhat)) AS mse, sqrt(avg((label - yhat) * (label - yhat))) AS rmse,
       avg(abs(label - yhat)) AS mae,
       1.0 - sum((label - yhat) * (label - yhat)) / (var_pop(label) * count(*)) AS r2
FROM (SELECT label, l_quantity * p_retailprice AS yhat FROM reg_table)""", ["reg_table"]))
def q_regression(spark, d):
    r = fx.reg_table(spark, d).withColumn("yhat", F.col("l_quantity") * F.col("p_retailprice"))
    return mt.regression_metrics(r, "label", "yhat")


@register("met_classification", sql=with_views(CLS_SQL.format(extra="", keys="", group=""), ["scores"], [PRED]))
def q_classification(spark, d):
    return mt.classification_metrics(_pred(fx.scores(spark, d)), "target", "pred")


@register("met_roc", sql=with_views("""
SELECT threshold, coalesce(CAST(fp_cum AS DOUBLE) / NULLIF(N, 0), 0) AS fpr,
       coalesce(CAST(tp_cum AS DOUBLE) / NULLIF(P, 0), 0) AS tpr FROM c CROSS JOIN tot
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""", ["scores"], ROC))
def q_roc(spark, d):
    return mt.roc_points(fx.scores(spark, d), "target", "p1")


@register("met_auc", sql=with_views("""
SELECT CASE WHEN any_value(P) = 0 OR any_value(N) = 0 THEN -1e8
            ELSE sum(fp * (2 * tp_cum - tp)) / (2.0 * any_value(P) * any_value(N)) END AS auc
FROM c CROSS JOIN tot""", ["scores"], ROC))
def q_auc(spark, d):
    return mt.auc(fx.scores(spark, d), "target", "p1")


@register("met_ap", sql=with_views("""
SELECT coalesce(sum(CAST(tp AS DOUBLE) / P * tp_cum / (tp_cum + fp_cum)), 0) AS ap FROM c CROSS JOIN tot""",
                                   ["scores"], ROC))
def q_ap(spark, d):
    return mt.average_precision(fx.scores(spark, d), "target", "p1")


BATCH = ("pb", CLS_SQL.format(extra=", batch", keys="batch,", group="GROUP BY batch"))


@register("met_batchwise", sql=with_views("""
SELECT sum(n) AS n, sum(accuracy * n) / sum(n) AS accuracy, sum(precision * n) / sum(n) AS precision,
       sum(recall * n) / sum(n) AS recall, sum(f1 * n) / sum(n) AS f1
FROM pb WHERE n >= 8""", ["scores"], [PRED, BATCH]))
def q_batchwise(spark, d):
    return mt.batchwise(_pred(fx.scores(spark, d)), "target", "pred", "batch", min_rows=8)


@register("agg_running_meter", sql=with_views("""
SELECT batch, accuracy, n, sum(accuracy * n) OVER w / sum(CAST(n AS DOUBLE)) OVER w AS running_avg
FROM pb WINDOW w AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ["scores"], [PRED, BATCH]))
def q_running_meter(spark, d):
    per = mt.classification_metrics(_pred(fx.scores(spark, d)), "target", "pred", ["batch"])
    return mt.running_meter(per, "batch", "accuracy", "n")


@register("agg_every_k", sql=with_views("""
SELECT CAST(batch // 4 AS BIGINT) AS chunk, avg(accuracy) AS mean_value, count(*) AS steps FROM pb GROUP BY 1""",
                                        ["scores"], [PRED, BATCH]))
def q_every_k(spark, d):
    per = mt.classification_metrics(_pred(fx.scores(spark, d)), "target", "pred", ["batch"])
    return mt.every_k(per, "batch", "accuracy", 4)


@register("met_score_tables", sql=with_views("""
SELECT 'roc' AS kind, coalesce(CAST(fp_cum AS DOUBLE) / NULLIF(N, 0), 0) AS x,
       coalesce(CAST(tp_cum AS DOUBLE) / NULLIF(P, 0), 0) AS y, CAST(NULL AS DOUBLE) AS n FROM c CROSS JOIN tot
UNION ALL SELECT 'roc', 0.0, 0.0, NULL
UNION ALL
SELECT 'score_hist', CAST(least(floor(p1 * 10), 9) AS DOUBLE), NULL, CAST(count(*) AS DOUBLE) FROM scores GROUP BY 2
UNION ALL
SELECT 'scatter', label, l_quantity * p_retailprice, NULL FROM reg_table
UNION ALL
SELECT 'heat', CAST(target AS DOUBLE), CAST(pred AS DOUBLE), CAST(count(*) AS DOUBLE) FROM sp GROUP BY target, pred""",
                                             ["scores", "reg_table"], [*ROC, PRED]))
def q_score_tables(spark, d):
    """The tables behind the four plots: ROC curve, histogram of the scores, scatter of true
    and predicted values, heat map of true and predicted classes."""
    s = fx.scores(spark, d)
    none = F.lit(None).cast("double")
    roc = mt.roc_points(s, "target", "p1").select(F.lit("roc").alias("kind"), F.col("fpr").alias("x"),
                                                  F.col("tpr").alias("y"), none.alias("n"))
    hist = s.groupBy(F.least(F.floor(F.col("p1") * 10), F.lit(9)).cast("double").alias("x")).agg(
        F.count(F.lit(1)).cast("double").alias("n")).select(F.lit("score_hist").alias("kind"), "x", none.alias("y"), "n")
    scatter = fx.reg_table(spark, d).select(F.lit("scatter").alias("kind"), F.col("label").alias("x"),
                                            (F.col("l_quantity") * F.col("p_retailprice")).alias("y"), none.alias("n"))
    heat = _pred(s).groupBy("target", "pred").agg(F.count(F.lit(1)).cast("double").alias("n")).select(
        F.lit("heat").alias("kind"), F.col("target").cast("double").alias("x"), F.col("pred").cast("double").alias("y"), "n")
    return roc.unionByName(hist).unionByName(scatter).unionByName(heat)
