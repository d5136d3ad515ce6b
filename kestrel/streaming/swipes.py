"""Streaming multi-swipes: anchored runs per account in event-time order.

Files may come in any order and cut.  The rows of an account wait in its state until the
watermark has passed, then they are taken by (time, row id): a row continues the run if it
has the run's non-zero amount and comes less than ``window_s`` seconds after the run's
first row, and is emitted; any other row starts a new run.

*State* of an account (RocksDB, ``transformWithStateInPandas``):

* waiting rows, as a list with one entry per micro-batch while no more than ``HELD_ROWS`` of them are
  listed.  Of a busier account the rest waits by time slice of ``slice_s`` seconds, one entry per slice and micro-batch.
  A micro-batch never reads what is there, and an account costs it a fixed number of calls to the state, not one
  per row.  A timer at the end of the earliest slice takes all rows whose slice the watermark has
  passed: a worker holds the list and one slice of one account, however busy the account is;
* the current run's start and amount (two numbers), removed by a timer when no row can
  continue it;
* the number of entries by slice, of listed rows, and the time of the account's one timer.

*Late rows*, whose slice had ended before the watermark with which their micro-batch began,
and rows without a time are flagged and stored in a table of their own; they take no part in runs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from kestrel.operators.txn import SWIPE_WINDOW_S, AnchoredRuns
from kestrel.session import ship_package
from kestrel.streaming.events import Job, event_stream

OUT = "row_id long, account long, amount double, ts timestamp_ntz"
_FLAGGED = "row_id long, account long, amount double, us long, late boolean"
#: Rows of an account that wait in one list; what is beyond waits by time slice.
HELD_ROWS = 1 << 14
_ROW = np.dtype([("us", "<i8"), ("row_id", "<i8"), ("amount", "<f8")])


def transactions_of(events: DataFrame) -> DataFrame:
    """Transaction columns of the event stream; ``us`` is the time in microseconds."""
    return events.select(F.col("event_id").alias("row_id"), F.col("user_id").alias("account"),
                         F.unix_micros("ets").alias("us"),
                         (F.floor(F.col("value") / F.lit(25)) * F.lit(25)).cast("double").alias("amount"))


def continued(rows: np.ndarray, start: int | None, amount: float, window_us: int) -> tuple[np.ndarray, int, float]:
    """Which of the ordered ``rows`` continue a run, and the run (start, amount) after them.

    ``start`` is the current run's first time (None: no run)."""
    same = np.zeros(len(rows), bool)
    same[0] = start is not None and rows["amount"][0] == amount
    same[1:] = rows["amount"][1:] == rows["amount"][:-1]
    part = np.cumsum(~same)  # 0: still the current run's amount
    runs = AnchoredRuns(window_us)
    if same[0]:
        runs._group, runs._start = (0,), start
    follows = runs.mark([part], rows["us"]) & (rows["amount"] != 0)
    return follows, runs._start, float(rows["amount"][-1])


def in_order(rows: np.ndarray) -> np.ndarray:
    """``rows`` by time and row id."""
    return rows[np.lexsort((rows["row_id"], rows["us"]))]


class SwipeProcessor(StatefulProcessor):
    """See the module text.  Times are microseconds, timers milliseconds."""

    def __init__(self, window_s: int, slice_s: int):
        self._window, self._slice = window_s * 1_000_000, slice_s * 1_000_000

    def init(self, handle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "rows binary")
        self._sliced = handle.getMapState("sliced", "slice long, entry long", "rows binary")
        self._entries = handle.getValueState("entries", "sliced long, held long, timer long")
        self._run = handle.getValueState("run", "start long, amount double")

    def _end_ms(self, at):
        return (at + self._slice) // 1000

    def _frame(self, account, rows: np.ndarray, late: bool) -> pd.DataFrame:
        return pd.DataFrame({"row_id": rows["row_id"], "account": account, "amount": rows["amount"], "us": rows["us"],
                             "late": late})

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentWatermarkInMs()
        before = self._entries.get() or (0, 0, None)
        sliced, held, timer = before
        for frame in rows:
            untimed = frame["us"].isna()
            if untimed.any():
                yield frame.loc[untimed, ["row_id", "account", "amount", "us"]].assign(late=True)
                frame = frame.loc[~untimed]
            part = np.empty(len(frame), _ROW)
            for c in _ROW.names:
                part[c] = frame[c].to_numpy()
            part = in_order(part)
            at = part["us"] // self._slice * self._slice
            late = self._end_ms(at) <= now
            if late.any():
                yield self._frame(key[0], part[late], True)
                part, at = part[~late], at[~late]
            if not len(part):
                continue
            if held + len(part) <= HELD_ROWS:
                self._waiting.appendValue((part.tobytes(),))
                held += len(part)
            else:
                cuts = [*np.flatnonzero(np.diff(at, prepend=at[:1] - 1)).tolist(), len(at)]
                for i, j in zip(cuts, cuts[1:]):
                    self._sliced.updateValue((int(at[i]), sliced), (part[i:j].tobytes(),))
                    sliced += 1
            timer = self._timer(timer, self._end_ms(int(at[0])))
        if (sliced, held, timer) != before:
            self._entries.update((sliced, held, timer))

    def _timer(self, old: int | None, at: int) -> int:
        """The account's one timer: ``old`` (None: there is none) or ``at``, if that is earlier."""
        if old is not None and old <= at:
            return old
        if old is not None:
            self._handle.deleteTimer(old)
        self._handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        sliced, held, _ = self._entries.get() or (0, 0, None)
        start, amount = run = self._run.get() or (None, 0.0)
        listed = in_order(np.concatenate([np.empty(0, _ROW), *(np.frombuffer(r[0], _ROW) for r in self._waiting.get())])) if held \
            else np.empty(0, _ROW)
        n = int(np.count_nonzero(self._end_ms(listed["us"] // self._slice * self._slice) <= now))
        keys = sorted(tuple(k) for k in self._sliced.keys()) if sliced else []
        done = sum(self._end_ms(k[0]) <= now for k in keys)
        due: dict[int, list] = {}
        for k in keys[:done]:
            due.setdefault(k[0], []).append(k)
        i = 0
        for at, entries in (*due.items(), (None, [])):  # the slices, each with the listed rows up to its end, and what is left
            j = n if at is None else min(n, int(np.searchsorted(listed["us"], at + self._slice)))
            rows = listed[i:j]
            if entries:
                rows = in_order(np.concatenate([rows, *(np.frombuffer(self._sliced.getValue(k)[0], _ROW) for k in entries)]))
            if len(rows):
                follows, start, amount = continued(rows, start, amount, self._window)
                if follows.any():
                    yield self._frame(key[0], rows[follows], False)
            for k in entries:
                self._sliced.removeKey(k)
            i = j
        if n:
            held = len(listed) - n
            if held:
                self._waiting.put([(listed[n:].tobytes(),)])
            else:
                self._waiting.clear()
        ahead = [self._end_ms(int(listed["us"][n]) // self._slice * self._slice)] if held else []
        if len(keys) > done:
            ahead.append(self._end_ms(keys[done][0]))
        elif done:
            sliced = 0
        if start is not None:
            over = (start + self._window + self._slice) // 1000  # no row that is in time can continue the run then
            if over > now:
                ahead.append(over + 1)
                if (start, amount) != run:
                    self._run.update((start, amount))
            elif run[0] is not None:
                self._run.clear()
        if ahead:
            self._handle.registerTimer(min(ahead))
            self._entries.update((sliced, held, min(ahead)))
        else:
            self._entries.clear()

    def close(self) -> None:
        pass


def swipe_runs(txn: DataFrame, window_s: int = SWIPE_WINDOW_S, slice_s: int = 3600) -> DataFrame:
    """Stream of the rows after the first of an anchored run (late = false) and of the late rows."""
    ship_package(txn.sparkSession)
    found = txn.groupBy("account").transformWithStateInPandas(
        statefulProcessor=SwipeProcessor(window_s, slice_s), outputStructType=_FLAGGED, outputMode="Append",
        timeMode="EventTime")
    return found.select("row_id", "account", "amount", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "late")


def swipe_job(spark: SparkSession, folder: str, window_s: int = SWIPE_WINDOW_S, files_per_trigger: int = 16,
              watermark: str = "3650 days", slice_s: int = 3600, base: str | None = None) -> Job:
    """The stream over the event files of ``folder``.  ``watermark`` says how late a row may come;
    the default of a backfill takes files in any order."""
    return Job(spark, lambda beats: swipe_runs(transactions_of(
        event_stream(spark, folder, beats, watermark, files_per_trigger)), window_s, slice_s), base, ("late",))


def swipe_rows(job: Job, late: bool = False) -> DataFrame:
    """The rows of runs written so far, or the late rows."""
    return job.read(f"{OUT}, late boolean").where(F.col("late") == late).select("row_id", "account", "amount", "ts")


def run_available(spark: SparkSession, folder: str, window_s: int = SWIPE_WINDOW_S, files_per_trigger: int = 16) -> DataFrame:
    """Process every file present now, close the stream and return the rows of runs."""
    return swipe_rows(swipe_job(spark, folder, window_s, files_per_trigger).run().close())
