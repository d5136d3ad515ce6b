"""Structured Streaming queries."""

from __future__ import annotations

from kestrel.plans.q_ticks import _with, tick_ctes
from kestrel.plans.q_txn import T, swipe_sql
from kestrel.plans.registry import register
from kestrel.streaming import swipes as sw, ticks as st

STREAM_SQL = _with(tick_ctes()[:1], """
SELECT symbol, bin,
       count(*) FILTER (WHERE trdpx = 0) AS n_quote,
       avg(bid) FILTER (WHERE trdpx = 0) AS q_bid, avg(bidsz) FILTER (WHERE trdpx = 0) AS q_bidsz,
       avg(ask) FILTER (WHERE trdpx = 0) AS q_ask, avg(asksz) FILTER (WHERE trdpx = 0) AS q_asksz,
       count(*) FILTER (WHERE trdpx <> 0) AS n_trade,
       avg(trdpx) FILTER (WHERE trdpx <> 0) AS t_px, avg(trdsz) FILTER (WHERE trdpx <> 0) AS t_sz,
       avg(trdsd) FILTER (WHERE trdpx <> 0) AS t_sd
FROM (SELECT *, CAST(floor(time / 900000000) AS BIGINT) AS bin FROM (SELECT DISTINCT * FROM ticks))
GROUP BY symbol, bin""")


@register("str_tick_bins", sql=STREAM_SQL)
def q_stream_bins(spark, d):
    """Distinct ticks of a file stream in closed windows (append mode, availableNow) = the batch bins."""
    return st.run_available(spark, d)


@register("str_swipe", sql=swipe_sql([T], "SELECT row_id, account, amount, ts FROM transactions"))
def q_stream_swipes(spark, d):
    """Anchored runs over the stream of all transactions, taken in event-time order by keyed state and timers."""
    return sw.run_available(spark, d)
