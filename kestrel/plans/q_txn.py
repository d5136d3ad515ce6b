"""Transaction-anomaly queries: duplicate groups, reversals, multi-swipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import txn as tx
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import VIEWS


def _w(ctes, body):
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in ctes) + "\n" + body


T = ("transactions", VIEWS["transactions"])
DUP = ("dup", """
SELECT t.*, c.cnt > 1 AS is_dup
FROM transactions t JOIN (SELECT account, merchant_category, amount, count(*) AS cnt FROM transactions
                          GROUP BY ALL) c
  ON t.account IS NOT DISTINCT FROM c.account AND t.merchant_category IS NOT DISTINCT FROM c.merchant_category
 AND t.amount IS NOT DISTINCT FROM c.amount""")

REV = ("rev", """
SELECT row_id, account, ts, merchant_category, amount, balance, available, is_fraud, is_dup FROM (
  SELECT *, lead(amount, 1) OVER w AS a1, lead(available, 1) OVER w AS v1, lead(balance, 2) OVER w AS b2
  FROM dup WINDOW w AS (PARTITION BY account ORDER BY ts, row_id))
WHERE is_dup AND amount <> 0 AND a1 = amount AND b2 = balance AND available > v1""")
REV_SQL = _w([T, DUP, REV], "SELECT * FROM rev")


def swipe_sql(ctes, rows: str) -> str:
    """Rows after the first of an anchored run, among ``rows`` (row_id, account, amount, ts)."""
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({q}\n)" for n, q in [*ctes, ("d", rows), (
    "isl", """
SELECT *, sum(chg) OVER (PARTITION BY account ORDER BY ts, row_id) AS island
FROM (SELECT *, CASE WHEN lag(amount) OVER (PARTITION BY account ORDER BY ts, row_id) IS DISTINCT FROM amount
                     THEN 1 ELSE 0 END AS chg FROM d)"""), (
    "r", """
SELECT *, row_number() OVER (PARTITION BY account, island ORDER BY ts, row_id) AS k
FROM isl WHERE amount <> 0"""), (
    "rec(account, island, k, anchor_k, anchor_us)", f"""
SELECT account, island, k, k, epoch_us(ts) FROM r WHERE k = 1
UNION ALL
SELECT r.account, r.island, r.k,
       CASE WHEN epoch_us(r.ts) - rec.anchor_us < CAST({tx.SWIPE_WINDOW_S * 1000000} AS BIGINT) THEN rec.anchor_k ELSE r.k END,
       CASE WHEN epoch_us(r.ts) - rec.anchor_us < CAST({tx.SWIPE_WINDOW_S * 1000000} AS BIGINT) THEN rec.anchor_us
            ELSE epoch_us(r.ts) END
FROM rec JOIN r ON r.account = rec.account AND r.island = rec.island AND r.k = rec.k + 1""")]) + """
SELECT r.row_id, r.account, r.amount, r.ts FROM rec JOIN r
  ON rec.account = r.account AND rec.island = r.island AND rec.k = r.k
WHERE rec.anchor_k <> rec.k"""


SWIPE_SQL = swipe_sql([T, DUP], "SELECT row_id, account, amount, ts FROM dup WHERE is_dup")


@register("win_dup_all", sql=_w([T, DUP], "SELECT row_id, account, amount FROM dup WHERE is_dup"))
def q_dup_all(spark, d):
    return tx.mark_duplicates(fx.transactions(spark, d)).where("is_dup").select("row_id", "account", "amount")


@register("dup_rows_lineitem", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dup_lineitem(spark, d):
    from kestrel.sources.tables import load
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@register("win_reversal", sql=REV_SQL)
def q_reversal(spark, d):
    return tx.reversals(fx.transactions(spark, d))


@register("agg_reversal_profile", sql=_w([T, DUP, REV], """
SELECT count(DISTINCT account) / count(*) AS acct_ratio, count(*) AS n, avg(amount) AS mean_amount,
       count(*) FILTER (WHERE is_fraud) AS n_fraud
FROM rev"""))
def q_reversal_profile(spark, d):
    r = tx.reversals(fx.transactions(spark, d))
    return r.agg(F.try_divide(F.count_distinct("account"), F.count(F.lit(1))).alias("acct_ratio"),
                 F.count(F.lit(1)).alias("n"), F.avg("amount").alias("mean_amount"),
                 F.count_if("is_fraud").alias("n_fraud"))


@register("win_multiswipe", sql=SWIPE_SQL)
def q_multiswipe(spark, d):
    return tx.multi_swipes(fx.transactions(spark, d))
