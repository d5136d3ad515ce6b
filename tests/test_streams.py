"""Streams: event-time order, replayed batches, late rows, repeated ticks, state that expires."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.operators.txn import SWIPE_WINDOW_S
from kestrel.streaming import swipes as sw, ticks as st
from kestrel.streaming.events import EVENTS_SCHEMA


@pytest.fixture(scope="module")
def events(spark):
    """Small events with a busy account, equal times and equal amounts."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").toPandas().sort_values("event_id").reset_index(drop=True)
    ev.loc[ev.index % 3 == 0, "user_id"] = 1
    ev.loc[ev.index % 4 == 0, "value"] = 30.0
    ev.loc[ev.index % 5 == 0, "ts"] = ev["ts"].dt.floor("D")[ev.index % 5 == 0]
    return ev


def in_files(spark, folder, parts):
    """One file a part, in the order in which the stream reads them (by modification time)."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, EVENTS_SCHEMA).coalesce(1).write.parquet(str(folder / f"x{i}"))
        next((folder / f"x{i}").glob("part-*.parquet")).rename(folder / f"events-{i}.parquet")
    return str(folder)


def naive_swipes(ev, window_s=SWIPE_WINDOW_S):
    out = []
    for _, g in ev.groupby("user_id"):
        start, amount = None, 0.0
        for r in g.sort_values(["ts", "event_id"]).itertuples():
            a = r.value // 25 * 25.0
            if start is not None and a == amount != 0 and (r.ts - start).total_seconds() < window_s:
                out.append((r.event_id, r.user_id, a, r.ts.to_pydatetime()))
            else:
                start, amount = r.ts, a
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same_swipes(df, ev):
    assert sorted(map(tuple, df.collect())) == naive_swipes(ev)


def cut(ev, seed, parts):
    r = random.Random(seed)
    order = list(range(len(ev)))
    r.shuffle(order)
    ends = sorted(r.sample(range(1, len(ev)), parts - 1))
    return [ev.iloc[sorted(order[a:b])] for a, b in zip([0, *ends], [*ends, len(ev)])]


@pytest.mark.parametrize("seed", [1, 2])
def test_swipes_in_any_order_and_cut(spark, tmp_path, events, seed):
    folder = in_files(spark, tmp_path, cut(events, seed, 4))
    same_swipes(sw.run_available(spark, folder, files_per_trigger=1), events)


def test_swipes_from_later_files_first(spark, tmp_path, events):
    ev = events.sort_values("ts")
    folder = in_files(spark, tmp_path, [ev.iloc[500:], ev.iloc[:500]])
    same_swipes(sw.run_available(spark, folder, files_per_trigger=1), events)


def test_swipes_after_a_failed_batch(spark, tmp_path, events):
    """The sink fails after it has written; the restarted job replays that batch and doubles nothing."""
    (tmp_path / "in").mkdir()
    folder = in_files(spark, tmp_path / "in", cut(events, 3, 3))
    job = sw.swipe_job(spark, folder, files_per_trigger=1, watermark="2 days", base=str(tmp_path / "job"))
    write, failed = job.write, []

    def broken(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("killed")

    job.write = broken
    with pytest.raises(Exception, match="killed"):
        job.run()
    job.run().close()
    late = {r.row_id for r in sw.swipe_rows(job, late=True).collect()}
    assert failed and late and rows(sw.swipe_rows(job)) == rows(spark.createDataFrame(
        naive_swipes(events[~events.event_id.isin(late)]), sw.OUT))


def test_late_rows_have_their_own_table(spark, tmp_path, events):
    ev = events.sort_values("ts")
    ev = ev.assign(ts=ev["ts"].where(ev["event_id"] != ev["event_id"].iloc[3]))  # one row without a time
    folder = in_files(spark, tmp_path, [ev.iloc[500:600], ev.iloc[600:], ev.iloc[:500]])
    job = sw.swipe_job(spark, folder, files_per_trigger=1, watermark="1 hour").run().close()
    late = rows(sw.swipe_rows(job, late=True))
    kept = ev[~ev.event_id.isin([r[0] for r in late])]
    assert 490 <= len(late) <= 500 and ev["event_id"].iloc[3] in {r[0] for r in late}
    same_swipes(sw.swipe_rows(job), kept)


def test_state_expires(spark, tmp_path, events):
    folder = in_files(spark, tmp_path, cut(events, 4, 2))
    job = sw.swipe_job(spark, folder, files_per_trigger=1).run()

    def left(name):
        return spark.read.format("statestore").option("stateVarName", name).load(f"{job.base}/state").count()
    assert left("waiting") > 0
    job.close()
    assert left("waiting") == left("run") == left("entries") == 0


def test_runs_over_slices():
    """Slices of any size give the rows that one walk gives."""
    r = random.Random(7)
    for _ in range(50):
        n = 80
        ev = np.empty(n, sw._ROW)
        ev["us"] = np.sort([r.randrange(60) * r.choice([1, 20]) for _ in range(n)])
        ev["row_id"], ev["amount"] = np.arange(n), [r.choice([0.0, 25.0, 25.0, 50.0, float("nan")]) for _ in range(n)]
        want, start, amount = [], None, 0.0
        for us, _, a in ev.tolist():
            same = start is not None and a == amount and a != 0 and us - start < 40
            want.append(same)
            if not same:
                start, amount = us, a
        got, start, amount, at = [], None, 0.0, 0
        while at < n:
            size = r.choice([1, 2, 9, 30])
            follows, start, amount = sw.continued(ev[at:at + size], start, amount, 40)
            got += follows.tolist()
            at += size
        assert got == want


def test_bins_with_repeated_ticks(spark, tmp_path, events):
    """Files out of order that share many events give the batch bins of the distinct ticks."""
    from kestrel.operators import ticks as tk
    from kestrel.sources import fixtures as fx
    first, second = tmp_path / "twice", tmp_path / "once"
    first.mkdir(), second.mkdir()
    twice = in_files(spark, first, [events.iloc[400:], events.iloc[:600], events.iloc[100:200]])
    spark.createDataFrame(events, EVENTS_SCHEMA).write.parquet(str(second / "events.parquet"))
    batch = tk.tick_bins(fx.ticks(spark, str(second)), fx.TICK_BIN_US)
    got = st.run_available(spark, twice, files_per_trigger=1)

    def rounded(df):
        return sorted(tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r)
                      for r in df.select(sorted(df.columns)).na.fill(-1.0).collect())
    assert rounded(got) == rounded(batch)
    assert rounded(st.run_available(spark, str(second))) == rounded(batch)  # a folder of part files


class Handle:
    """State of one account in memory; counts the calls and holds the timers."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, set(), {}

    def _state(self, name, kind):
        outer, held = self, self.states.setdefault(name, {})

        class State:
            def __getattr__(self, call):
                def run(*a):
                    outer.calls += 1
                    return getattr(self, f"_{call}")(*a)
                return run

            def _exists(self):
                return bool(held)

            def _get(self):
                return iter(held.get(0, [])) if kind == "list" else held.get(0)

            def _update(self, value):
                held[0] = value

            def _put(self, values):
                held[0] = list(values)

            def _appendValue(self, value):
                held.setdefault(0, []).append(value)

            def _clear(self):
                held.clear()

            def _keys(self):
                return iter(list(held))

            def _getValue(self, k):
                return held[k]

            def _updateValue(self, k, value):
                held[k] = value

            def _removeKey(self, k):
                del held[k]
        return State()

    def getValueState(self, name, schema):
        return self._state(name, "value")

    def getListState(self, name, schema):
        return self._state(name, "list")

    def getMapState(self, name, key, value):
        return self._state(name, "map")

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def fed(parts, marks, window_s=40, slice_s=10):
    """(ids of runs, ids of late rows, handle) after the micro-batches ``parts`` of one account, each with the watermark of ``marks``."""
    p, handle, found = sw.SwipeProcessor(window_s, slice_s), Handle(), []
    p.init(handle)
    for rows, ms in zip([*parts, None], [*marks, 1 << 50]):
        if rows is not None:
            found += p.handleInputRows((1,), iter([rows]), Watermark(ms))
        while any(t <= ms for t in handle.timers):
            at = min(handle.timers)
            handle.timers.remove(at)
            found += p.handleExpiredTimer((1,), Watermark(ms), at)
    late = {r for f in found for r in f.loc[f["late"], "row_id"]}
    return {r for f in found for r in f.loc[~f["late"], "row_id"]}, late, handle


def account(r, n, seconds):
    return pd.DataFrame({"row_id": np.arange(n), "account": 1, "amount": [r.choice([0.0, 25.0, 25.0, 50.0]) for _ in range(n)],
                         "us": [r.randrange(seconds) * 1_000_000 for _ in range(n)]})


def test_calls_to_the_state_do_not_grow_with_the_rows_of_an_account():
    few, many = (fed([account(random.Random(1), n, 100_000)], [0])[2] for n in (5, 2000))
    assert many.calls <= few.calls + 2 and not any(many.states.values()) and not many.timers


@pytest.mark.parametrize("held", [0, 7, 40, 1 << 14])
def test_runs_of_listed_and_sliced_rows(monkeypatch, held):
    """Whatever waits in the list or by slice, and wherever the watermark stands: the runs of the rows that are not late."""
    monkeypatch.setattr(sw, "HELD_ROWS", held)
    r = random.Random(held)
    for _ in range(40):
        ev = account(r, 120, r.choice([60, 400, 3000]))
        ends = sorted(r.sample(range(1, 120), 5))
        parts = [ev.iloc[a:b] for a, b in zip([0, *ends], [*ends, 120])]
        marks = sorted(r.randrange(3000) * 1000 * r.choice([0, 1]) for _ in parts)
        got, late, handle = fed(parts, marks)
        assert not any(handle.states.values()) and not handle.timers
        assert late == {i for part, ms in zip(parts, marks) for i, us in zip(part["row_id"], part["us"])
                        if (us // 10_000_000 + 1) * 10_000 <= ms}
        want, start, amount = set(), None, 0.0
        for i, a, us in sorted(zip(ev["row_id"], ev["amount"], ev["us"]), key=lambda x: (x[2], x[0])):
            if i in late:
                continue
            if start is not None and a == amount != 0 and us - start < 40_000_000:
                want.add(i)
            else:
                start, amount = us, a
        assert got == want
