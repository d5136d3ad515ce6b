"""Transaction anomalies: duplicate groups, reversals, multi-swipes.

Skew: an account (or a duplicate key) may hold a large share of all rows, so
no step windows over a bare account partition:

* duplicate groups are counted with a partial aggregate and joined back;
* neighbours ("next row", "row after next") come from windows over range
  partitions of (account, time), which split a hot account, with halo rows at
  the partition ends;
* anchored multi-swipe runs need an ordered pass, but only inside groups that
  can be cut exactly: a run never spans a change of amount nor a gap of at
  least the window, so groups are (account, run of equal amount, gap segment).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.order import running_sum, with_neighbours

# Duplicate key of the stand-in table and the swipe window.
DUP_KEYS = ["account", "merchant_category", "amount"]
SWIPE_WINDOW_S = 12 * 3600
HOUR_US = 3_600_000_000
ORDER = ["ts", "row_id"]


def _micros(c: str = "ts"):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def mark_duplicates(df: DataFrame, keys: list[str] = DUP_KEYS, out: str = "is_dup") -> DataFrame:
    """True for every member of a key group with more than one row (keep=False).
    Nulls group together (null-safe join)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    a, b = df.alias("a"), counts.alias("b")
    cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return a.join(b, cond).select("a.*", (F.col("b._cnt") > 1).alias(out))


def reversals(txn: DataFrame, keys: list[str] = DUP_KEYS) -> DataFrame:
    """Duplicate-group rows with non-zero amount whose next row (same account,
    by time) has the same amount and lower available money, and whose row
    after next restores this row's balance."""
    d = mark_duplicates(txn, keys)
    nb = with_neighbours(d, "account", ORDER, ["amount", "available", "balance"], [1, 2])
    return (nb.where(F.col("is_dup") & (F.col("amount") != 0)
                     & (F.col("amount_next1") == F.col("amount"))
                     & (F.col("balance_next2") == F.col("balance"))
                     & (F.col("available") > F.col("available_next1")))
              .drop("amount_next1", "available_next1", "balance_next1", "amount_next2",
                    "available_next2", "balance_next2"))


def swipe_groups(dups: DataFrame, window_s: int = SWIPE_WINDOW_S) -> DataFrame:
    """(account, grp) groups of duplicate rows that anchored runs cannot cross; groups of one
    row, which hold no run, are left out."""
    far = F.lit(window_s * 1_000_000)
    d = dups.withColumn("_us", _micros("ts"))
    nb = with_neighbours(d, "account", ORDER, ["amount", "_us"], [-1, 1])

    def cut(amount, us):
        return F.col(amount).isNull() | (F.col(amount) != F.col("amount")) | (F.abs(F.col("_us") - F.col(us)) >= far)
    nb = nb.withColumns({"_brk": cut("amount_prev1", "_us_prev1").cast("long"), "_ends": cut("amount_next1", "_us_next1")})
    g = running_sum(nb, ["account"], ORDER, ["_brk"], suffix="_cum")
    return g.where((F.col("_brk") == 0) | ~F.col("_ends")).withColumnRenamed("_brk_cum", "grp").drop(
        "amount_prev1", "_us_prev1", "amount_next1", "_us_next1", "_brk", "_ends")


class AnchoredRuns:
    """Marks the rows after the first of an anchored run in rows sorted by (group, time).

    A run starts at the first row of a group, and again at the first row at least
    ``window_us`` after the run's start (with ``same_hour`` also at a later clock hour).
    Rows come in any cut: all that is kept between two calls is the last group and the
    start of its run.
    """

    def __init__(self, window_us: int, same_hour: bool = False):
        self._window, self._same_hour = window_us, same_hour
        self._group, self._start = None, 0

    def _end(self, t: np.ndarray, start: int) -> int:
        """First position of sorted ``t`` outside the run that started at time ``start``."""
        j = int(np.searchsorted(t, start + self._window, side="left"))
        if self._same_hour:
            j = min(j, int(np.searchsorted(t, (start // HOUR_US + 1) * HOUR_US, side="left")))
        return j

    def mark(self, groups: list[np.ndarray], t: np.ndarray) -> np.ndarray:
        n = len(t)
        follows = np.ones(n, dtype=bool)
        if not n:
            return follows
        change = np.zeros(n, dtype=bool)
        change[0] = True
        for g in groups:
            change[1:] |= g[1:] != g[:-1]
        cuts = [*np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            group = tuple(g[a] for g in groups)
            part = t[a:b]
            if group == self._group:
                i = self._end(part, self._start)
            else:
                self._group, i = group, 0
            while i < len(part):
                follows[a + i] = False
                self._start = int(part[i])
                i = max(i + 1, self._end(part, self._start))
        return follows


def multi_swipes(txn: DataFrame, keys: list[str] = DUP_KEYS, window_s: int = SWIPE_WINDOW_S,
                 same_hour: bool = False) -> DataFrame:
    """Rows after the first of an anchored run: consecutive duplicate rows of an
    account with the same non-zero amount, less than ``window_s`` seconds after
    the run's FIRST row (optionally also in the same clock hour).

    Groups are hash-partitioned on (account, grp) and sorted inside each
    partition; one ordered ``mapInPandas`` pass per partition walks them batch by
    batch.  It carries only the start of the current run, so a dense run of any length
    takes constant memory."""
    from kestrel.session import ship_package
    ship_package(txn.sparkSession)
    dups = mark_duplicates(txn, keys).where("is_dup").select("row_id", "account", "amount", "ts")
    g = swipe_groups(dups, window_s).where(F.col("amount") != 0).select("row_id", "account", "amount", "ts", "grp", "_us")
    ordered = g.repartition("account", "grp").sortWithinPartitions("account", "grp", "_us", "row_id")

    def run(batches):
        runs = AnchoredRuns(window_s * 1_000_000, same_hour)
        for b in batches:
            follows = runs.mark([b["account"].to_numpy(), b["grp"].to_numpy()], b["_us"].to_numpy(np.int64))
            yield b.loc[follows, ["row_id", "account", "amount", "ts"]]

    return ordered.mapInPandas(run, "row_id long, account long, amount double, ts timestamp_ntz")
