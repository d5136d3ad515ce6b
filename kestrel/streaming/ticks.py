"""Streaming tick bins: event files -> watermark -> no repeated ticks -> 15-minute windows.

Equal ticks are removed as in the batch operator, with state that is kept until the
watermark has passed the tick.  A window is emitted once, when the watermark closes it; ticks
later than that are dropped, so ``watermark`` says how late they may come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.fixtures import EPOCH_NTZ, TICK_BIN_US
from kestrel.streaming.events import Job, event_stream

_MEANS = ["q_bid", "q_bidsz", "q_ask", "q_asksz", "t_px", "t_sz", "t_sd"]
_OUT = "symbol string, start timestamp_ntz, n_quote long, n_trade long, " + ", ".join(f"{c} double" for c in _MEANS)


def ticks_of(events: DataFrame) -> DataFrame:
    """Tick columns of the event stream."""
    trade = F.col("event_type") == "purchase"
    eid, px, zero = F.col("event_id"), F.col("value") + F.lit(100), F.lit(0.0)
    return events.select(
        F.when(F.col("user_id") % 2 == 0, F.lit("STOCKA")).otherwise(F.lit("STOCKB")).alias("symbol"), "ets",
        F.when(trade, zero).otherwise(px).alias("bid"),
        F.when(trade, zero).otherwise((eid % 10 + 1).cast("double")).alias("bidsz"),
        F.when(trade, zero).otherwise(px + (eid % 5 + 1).cast("double") * F.lit(0.1)).alias("ask"),
        F.when(trade, zero).otherwise((eid % 7 + 1).cast("double")).alias("asksz"),
        F.when(trade, px).otherwise(zero).alias("trdpx"),
        F.when(trade, (eid % 4 + 1).cast("double")).otherwise(zero).alias("trdsz"),
        F.when(trade, F.when(eid % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))).otherwise(zero).alias("trdsd"))


def windowed_bins(ticks: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Quote and trade means per symbol and window of the distinct ticks."""
    q = F.col("trdpx") == 0
    tr = ~q
    bins = (ticks.dropDuplicatesWithinWatermark(ticks.columns)
            .groupBy("symbol", F.window("ets", width).alias("w"))
            .agg(F.count_if(q).alias("n_quote"), F.count_if(tr).alias("n_trade"),
                 F.avg(F.when(q, F.col("bid"))).alias("q_bid"), F.avg(F.when(q, F.col("bidsz"))).alias("q_bidsz"),
                 F.avg(F.when(q, F.col("ask"))).alias("q_ask"), F.avg(F.when(q, F.col("asksz"))).alias("q_asksz"),
                 F.avg(F.when(tr, F.col("trdpx"))).alias("t_px"), F.avg(F.when(tr, F.col("trdsz"))).alias("t_sz"),
                 F.avg(F.when(tr, F.col("trdsd"))).alias("t_sd")))
    return bins.withColumn("start", F.col("w.start").cast("timestamp_ntz")).drop("w")


def tick_job(spark: SparkSession, folder: str, watermark: str = "3650 days", files_per_trigger: int = 16,
             base: str | None = None) -> Job:
    """The stream over the event files of ``folder``; a backfill's default takes files in any order."""
    return Job(spark, lambda beats: windowed_bins(ticks_of(event_stream(spark, folder, beats, watermark, files_per_trigger))), base)


def bins_written(job: Job) -> DataFrame:
    """The bins written so far, with the batch operator's bin number."""
    us = F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, start)")
    return job.read(_OUT).select("symbol", (us / F.lit(TICK_BIN_US)).cast("long").alias("bin"),
                                 "n_quote", "n_trade", *_MEANS)


def run_available(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Process every file present now, close the stream and return the bins."""
    return bins_written(tick_job(spark, folder, files_per_trigger=files_per_trigger).run().close())
