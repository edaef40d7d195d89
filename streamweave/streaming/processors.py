"""``transformWithStateInPandas`` processors: the reference's keyed state on
streams, one output per input row where the reference emits one.

Rows of one key inside one micro-batch come unordered; each processor
sorts them (by ``seq``, or by (timestamp, seq) for event-time folds).
That buffer is bounded by the trigger size, not by the key's history, which
lives in the state store (RocksDB: ``runner.use_rocksdb_state``): give the
source ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` when a backlog of
one key would not fit into a task.

Use with ``df.groupBy(key).transformWithStateInPandas(Processor(...),
outputStructType=Processor.schema(...), outputMode="Append",
timeMode=...)``; ``apply`` does exactly that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from streamweave.functions.time import duration_label, duration_ms
from streamweave.operators.folds import JAVA_DOUBLE_MIN_VALUE


def _batch(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    parts = [p for p in rows if len(p)]
    if not parts:
        return pd.DataFrame()
    return pd.concat(parts, ignore_index=True).sort_values(order, kind="stable")


def apply(df: DataFrame, key: str, processor: StatefulProcessor, schema: str, time_mode: str = "None",
          event_time_col: str | None = None, initial: DataFrame | None = None) -> DataFrame:
    """``initial``: the state that a bounded run left, one row per key (see
    ``operators.state``: ``counts_so_far``, ``last_readings``). The query's
    first batch loads it, a restart from a checkpoint goes on from its own."""
    kw = {}
    if initial is not None:
        kw["initialState"] = initial.groupBy(key)
    if event_time_col:
        kw["eventTimeColumnName"] = event_time_col
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=time_mode, **kw)


class RunningCount(StatefulProcessor):
    """ST2/ST3 (A2 on words): per input row, the key's count so far, on top
    of the (key, count) rows of an initial state."""

    def __init__(self, key: str = "id"):
        self.key = key

    @staticmethod
    def schema(key: str = "id", key_type: str = "string") -> str:
        return f"{key} {key_type}, seq long, count long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "c long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        if len(initialState):
            self.count.update((int(initialState["count"].sum()),))

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        c = self.count.get()[0] if self.count.exists() else 0
        counts = c + np.arange(1, len(b) + 1, dtype=np.int64)
        self.count.update((int(counts[-1]),))
        yield pd.DataFrame({self.key: key[0], "seq": b["seq"].to_numpy(), "count": counts})

    def close(self) -> None:
        pass


class JumpAlert(StatefulProcessor):
    """ST7: (id, lastTemp, temperature) when |temp - last| >= threshold;
    last starts at 0.0, or at the temperature of an initial state's row."""

    def __init__(self, threshold: float = 10.0, initial: float = 0.0):
        self.threshold, self.initial = threshold, initial

    @staticmethod
    def schema() -> str:
        return "id string, lastTemp double, temperature double, seq long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "t double")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        if len(initialState):
            self.last.update((float(initialState["temperature"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        first = self.last.get()[0] if self.last.exists() else self.initial
        temps = b["temperature"].to_numpy()
        prev = np.concatenate([[first], temps[:-1]])
        self.last.update((float(temps[-1]),))
        hit = np.abs(temps - prev) >= self.threshold
        if hit.any():
            yield pd.DataFrame({"id": key[0], "lastTemp": prev[hit], "temperature": temps[hit],
                                "seq": b["seq"].to_numpy()[hit]})

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """W5 ``countWindow(size, slide)`` with list state holding the last
    ``size`` temperatures of the key."""

    def __init__(self, size: int = 10, slide: int = 2):
        self.size, self.slide = size, slide

    @staticmethod
    def schema() -> str:
        return "id string, seq long, size long, min_temperature double, max_temperature double, value string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("buf", "t double")
        self.count = handle.getValueState("count", "c long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        buf = [t[0] for t in self.buf.get()] if self.buf.exists() else []
        n = self.count.get()[0] if self.count.exists() else 0
        temps = np.concatenate([buf, b["temperature"].to_numpy(float)])
        # Row i of the batch ends the window of the last ``size`` of temps[:len(buf) + i + 1].
        padded = np.concatenate([np.full(self.size - 1, np.nan), temps])
        frames = np.lib.stride_tricks.sliding_window_view(padded, self.size)[len(buf):]
        fired = np.flatnonzero((n + 1 + np.arange(len(b))) % self.slide == 0)
        sizes = np.minimum(self.size, len(buf) + 1 + fired)
        self.buf.put([(float(t),) for t in temps[-self.size:]])
        self.count.update((n + len(b),))
        if len(fired):
            yield pd.DataFrame({
                "id": key[0], "seq": b["seq"].to_numpy()[fired], "size": sizes,
                "min_temperature": np.nanmin(frames[fired], axis=1), "max_temperature": np.nanmax(frames[fired], axis=1),
                "value": [f"{key[0]}{k}" for k in sizes.tolist()]})

    def close(self) -> None:
        pass


class RisingAlert(StatefulProcessor):
    """ST10 (D3) with event-time timers: a rise arms a timer at t + interval
    when none is armed; a fall deletes it; the timer firing (watermark past
    the deadline), or a later row past it, emits the alert."""

    def __init__(self, interval: str = "10 seconds"):
        self.n = duration_ms(interval)

    @staticmethod
    def schema() -> str:
        return "id string, alert_time long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t double")
        self.armed = handle.getValueState("armed", "d long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["timestamp", "seq"])
        if not b.empty:
            b = b[b["temperature"].notna()]  # readings without a value take no part
        if b.empty:
            return
        last = self.last.get()[0] if self.last.exists() else JAVA_DOUBLE_MIN_VALUE
        armed = self.armed.get()[0] if self.armed.exists() else None
        out = []
        for t, temp in zip(b["timestamp"].tolist(), b["temperature"].tolist()):
            t = int(t)
            if armed is not None and t > armed:
                out.append(armed)
                self.handle.deleteTimer(armed)
                armed = None
            if temp > last and armed is None:
                armed = t + self.n
                self.handle.registerTimer(armed)
            elif temp < last and armed is not None:
                self.handle.deleteTimer(armed)
                armed = None
            last = float(temp)
        self.last.update((last,))
        if armed is None:
            self.armed.clear()
        else:
            self.armed.update((armed,))
        if out:
            yield pd.DataFrame({"id": key[0], "alert_time": out})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        self.armed.clear()
        yield pd.DataFrame({"id": [key[0]], "alert_time": [expiredTimerInfo.getExpiryTimeInMs()]})

    def close(self) -> None:
        pass


class LoginFail(StatefulProcessor):
    """ST14 (D7): failures within ``window`` of the first one, cancelled by a
    success; an event-time timer closes the episode. ``timestamp`` is in
    seconds; the timer is one ms after the window's inclusive end."""

    def __init__(self, window: str = "2 seconds", max_fails: int = 1):
        self.w = duration_ms(window) // 1000
        self.label = duration_label(window)
        self.max_fails = max_fails

    @staticmethod
    def schema() -> str:
        return "userId long, firstFailTime long, lastFailTime long, warningMsg string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start long, last long, n long")

    def _timer(self, start: int) -> int:
        return (start + self.w) * 1000 + 1

    def _close(self, key, o, out):
        if o is not None and o[2] >= self.max_fails:
            out.append((key[0], o[0], o[1], f"login fail in {self.label} for {o[2]} times"))

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["timestamp", "seq"])
        if b.empty:
            return
        o = list(self.open.get()) if self.open.exists() else None
        out = []
        for t, st in zip(b["timestamp"].tolist(), b["loginState"].tolist()):
            t = int(t)
            if o is not None and t > o[0] + self.w:
                self._close(key, o, out)
                self.handle.deleteTimer(self._timer(o[0]))
                o = None
            if st == "fail":
                if o is None:
                    o = [t, t, 1]
                    self.handle.registerTimer(self._timer(t))
                else:
                    o[1], o[2] = t, o[2] + 1
            elif o is not None:
                self.handle.deleteTimer(self._timer(o[0]))
                o = None
        if o is None:
            self.open.clear()
        else:
            self.open.update(tuple(o))
        if out:
            yield pd.DataFrame(out, columns=["userId", "firstFailTime", "lastFailTime", "warningMsg"])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        o = self.open.get() if self.open.exists() else None
        self.open.clear()
        out = []
        self._close(key, o, out)
        if out:
            yield pd.DataFrame(out, columns=["userId", "firstFailTime", "lastFailTime", "warningMsg"])

    def close(self) -> None:
        pass


class DelayTimer(StatefulProcessor):
    """ST8/ST9 (D10): per row an event-time timer at timestamp + delay; on
    expiry emit (key, deadline) with the watermark and processing time the
    timer saw (the process function's context)."""

    def __init__(self, delay_ms: int = 100):
        self.delay = delay_ms

    @staticmethod
    def schema() -> str:
        return "id string, deadline long, watermark long, processing_time long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        for b in rows:
            for t in b["timestamp"]:
                self.handle.registerTimer(int(t) + self.delay)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        yield pd.DataFrame({"id": [key[0]], "deadline": [expiredTimerInfo.getExpiryTimeInMs()],
                            "watermark": [timerValues.getCurrentWatermarkInMs()],
                            "processing_time": [timerValues.getCurrentProcessingTimeInMs()]})

    def close(self) -> None:
        pass


class FirstVisitPerDay(StatefulProcessor):
    """A10/ST12: count a visit only when the key's last counted day differs.
    With ``ttl_ms`` the state expires (timeMode ProcessingTime); run it with
    a processing-time trigger -- in this build such a query did not finish
    under ``availableNow``. ``ttl_ms=None`` works in timeMode None."""

    def __init__(self, ttl_ms: int | None = 86_400_000):
        self.ttl = ttl_ms

    @staticmethod
    def schema() -> str:
        return "userId long, day long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.day = handle.getValueState("day", "d long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["timestamp", "seq"])
        if b.empty:
            return
        cur = self.day.get()[0] if self.day.exists() else None
        out = []
        for d in (b["timestamp"] // 86_400):
            if d != cur:
                out.append(int(d))
                cur = int(d)
        self.day.update((cur,))
        if out:
            yield pd.DataFrame({"userId": key[0], "day": out})

    def close(self) -> None:
        pass


class DailyVisit(StatefulProcessor):
    """A10/ST12 with expiry in event time: a user's first visit of each day.

    The state is a map of days seen; a timer at a day's end removes the day
    once the watermark is past it, and the key's state with its last day. Rows
    may come in any order within the watermark's delay. Runs in timeMode
    EventTime, and ends under ``availableNow``."""

    DAY_MS = 86_400_000

    @staticmethod
    def schema() -> str:
        return "userId long, day long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day long", "seen boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        new = set()
        for b in rows:
            new |= {d for d in np.unique(b["timestamp"].to_numpy() // 86_400).tolist() if d not in new}
        new = sorted(d for d in new if not self.days.containsKey((d,)))
        for d in new:
            self.days.updateValue((d,), (True,))
            self.handle.registerTimer((d + 1) * self.DAY_MS)
        if new:
            yield pd.DataFrame({"userId": key[0], "day": new})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        self.days.removeKey((expiredTimerInfo.getExpiryTimeInMs() // self.DAY_MS - 1,))
        return iter([])

    def close(self) -> None:
        pass


class SeenFilter(StatefulProcessor):
    """ST11 with MapState (the reference's form): per item, a map of seen
    timestamps; the first row of each (item, timestamp) passes.

    ``retention_s`` bounds the map: after each batch, timestamps older than
    the newest seen minus ``retention_s`` are removed (exact when input is
    ascending, as the reference assumes; 0 keeps only the newest second,
    the reference's own behaviour). None keeps every timestamp."""

    def __init__(self, ttl_ms: int | None = None, retention_s: int | None = None):
        self.ttl = ttl_ms
        self.retention = retention_s

    @staticmethod
    def schema() -> str:
        return "itemId long, timestamp long, seq long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "ts long", "s long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        out = []
        for t, s in zip(b["timestamp"].tolist(), b["seq"].tolist()):
            k = (int(t),)
            if not self.seen.containsKey(k):
                self.seen.updateValue(k, (int(s),))
                out.append((key[0], int(t), int(s)))
        if self.retention is not None:
            seen = [k[0] for k in self.seen.keys()]
            horizon = max(seen) - self.retention
            for old in (x for x in seen if x < horizon):
                self.seen.removeKey((old,))
        if out:
            yield pd.DataFrame(out, columns=["itemId", "timestamp", "seq"])

    def close(self) -> None:
        pass


class RollingMaxBy(StatefulProcessor):
    """A3 ``maxBy(temperature)`` per input row: the whole record holding the
    max so far (a tie keeps the earlier record)."""

    @staticmethod
    def schema() -> str:
        return "input_seq long, id string, timestamp long, temperature double, seq long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "timestamp long, temperature double, seq long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        names = ["timestamp", "temperature", "seq"]
        seqs = b["seq"].to_numpy()
        if self.best.exists():  # the record held so far stands before the batch
            b = pd.concat([pd.DataFrame([tuple(self.best.get())], columns=names), b[names]], ignore_index=True)
        temps = b["temperature"].to_numpy(float)
        before = np.concatenate([[-np.inf], np.maximum.accumulate(temps)[:-1]])
        leads = temps > before
        leads[0] = True
        held = np.maximum.accumulate(np.where(leads, np.arange(len(temps)), 0))
        out = b[names].iloc[held].reset_index(drop=True)
        self.best.update((int(out["timestamp"].iloc[-1]), float(out["temperature"].iloc[-1]), int(out["seq"].iloc[-1])))
        out = out.iloc[len(out) - len(seqs):]
        yield pd.DataFrame({"input_seq": seqs, "id": key[0], **{c: out[c].to_numpy() for c in names}})

    def close(self) -> None:
        pass


class RollingReduce(StatefulProcessor):
    """A5 / ST6 reduce per input row: (id, timestamp of the latest record,
    max temperature so far) -- the reducing state's fold."""

    @staticmethod
    def schema() -> str:
        return "input_seq long, id string, timestamp long, temperature double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "m double")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        temps = b["temperature"].to_numpy()
        start = self.acc.get()[0] if self.acc.exists() else -np.inf
        run = np.maximum.accumulate(np.concatenate([[start], temps]))[1:]
        self.acc.update((float(run[-1]),))
        yield pd.DataFrame({"input_seq": b["seq"].to_numpy(), "id": key[0], "timestamp": b["timestamp"].to_numpy(),
                            "temperature": run})

    def close(self) -> None:
        pass


class RollingMax(StatefulProcessor):
    """A4 ``max(temperature)`` per input row: the running maximum; the other
    fields stay from the key's first record."""

    @staticmethod
    def schema() -> str:
        return "input_seq long, id string, timestamp long, temperature double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "first_ts long, m double")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        ts, start = self.acc.get() if self.acc.exists() else (int(b["timestamp"].iloc[0]), -np.inf)
        run = np.maximum.accumulate(np.concatenate([[start], b["temperature"].to_numpy(float)]))[1:]
        self.acc.update((int(ts), float(run[-1])))
        yield pd.DataFrame({"input_seq": b["seq"].to_numpy(), "id": key[0], "timestamp": int(ts), "temperature": run})

    def close(self) -> None:
        pass


class WindowMin(StatefulProcessor):
    """W9/E3 per (id, window_start): minBy at the window's close, then once per
    allowed late row; later rows come out as ``too_late``.

    The engine's watermark runs ``size + lateness`` behind the window clock
    (see ``forms.window_min_stream``), so the clock is the watermark plus
    that. The close is an event-time timer; a second one clears the state
    when the window can take no more rows. Before the first watermark every
    row is on time."""

    def __init__(self, size_ms: int, late_ms: int):
        self.size, self.late, self.lag = size_ms, late_ms, size_ms + late_ms

    @staticmethod
    def schema() -> str:
        return ("id string, window_start long, window_end long, firing string, trigger_seq long, timestamp long, "
                "temperature double, seq long")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "temperature double, seq long, timestamp long")
        self.last = handle.getValueState("last", "seq long, closed boolean")

    def _row(self, key, firing, trigger, best):
        return (key[0], int(key[1]), int(key[1]) + self.size, firing, int(trigger), int(best[2]), float(best[0]), int(best[1]))

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        end = int(key[1]) + self.size
        mark = timerValues.getCurrentWatermarkInMs()
        clock = mark + self.lag if mark > 0 else None
        out, names = [], [c.split()[0] for c in self.schema().split(", ")]
        records = list(zip(b["temperature"].tolist(), b["seq"].tolist(), b["timestamp"].tolist()))
        if clock is not None and clock >= end - 1 + self.late:
            out = [self._row(key, "too_late", r[1], r) for r in records]
        elif clock is None or clock < end - 1:
            best = min([*([tuple(self.best.get())] if self.best.exists() else []), *records])
            if not self.best.exists():
                self.handle.registerTimer(end - 1 - self.lag)
                self.handle.registerTimer(end - 1 + self.late - self.lag)
            self.best.update(best)
            self.last.update((int(max(r[1] for r in records)), False))
        else:
            if not self.best.exists():  # no on-time row: the window opens late
                self.handle.registerTimer(end - 1 + self.late - self.lag)
            elif not self.last.get()[1]:  # rows come before the batch's timers: close the window first
                out.append(self._row(key, "on_time", self.last.get()[0], tuple(self.best.get())))
            for r in records:
                best = min([*([tuple(self.best.get())] if self.best.exists() else []), r])
                self.best.update(best)
                self.last.update((int(r[1]), True))
                out.append(self._row(key, "late", r[1], best))
        if out:
            yield pd.DataFrame(out, columns=names)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        close = int(key[1]) + self.size - 1 - self.lag
        if expiredTimerInfo.getExpiryTimeInMs() > close or self.late == 0:
            if self.late == 0 and self.last.exists() and not self.last.get()[1]:
                yield self._frame(key)
            self.best.clear()
            self.last.clear()
        elif self.last.exists() and not self.last.get()[1]:
            yield self._frame(key)
            self.last.update((int(self.last.get()[0]), True))

    def _frame(self, key):
        return pd.DataFrame([self._row(key, "on_time", self.last.get()[0], tuple(self.best.get()))],
                            columns=[c.split()[0] for c in self.schema().split(", ")])

    def close(self) -> None:
        pass


class EarlyFiring(StatefulProcessor):
    """W11 on a stream: per (id, window_start) emit the running count and max
    at every ``every``-th arrival; an event-time timer at the window end plus
    ``keep_ms`` clears the window's state."""

    def __init__(self, every: int, keep_ms: int = 0):
        self.every, self.keep = every, keep_ms

    @staticmethod
    def schema() -> str:
        return "id string, window_start long, window_end long, fired_at_seq long, count long, max_temperature double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.acc = handle.getValueState("acc", "n long, m double, window_end long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        b = _batch(rows, ["seq"])
        if b.empty:
            return
        if self.acc.exists():
            n, m, end = self.acc.get()
        else:
            n, m, end = 0, -np.inf, int(b["window_end"].iloc[0])
            self.handle.registerTimer(end + self.keep)
        counts = n + np.arange(1, len(b) + 1)
        tops = np.maximum.accumulate(np.concatenate([[m], b["temperature"].to_numpy(float)]))[1:]
        self.acc.update((int(counts[-1]), float(tops[-1]), end))
        hit = counts % self.every == 0
        if hit.any():
            yield pd.DataFrame({"id": key[0], "window_start": int(key[1]), "window_end": end,
                                "fired_at_seq": b["seq"].to_numpy()[hit], "count": counts[hit], "max_temperature": tops[hit]})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo):
        self.acc.clear()
        return iter([])

    def close(self) -> None:
        pass


def apply_multi(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str,
                time_mode: str = "None") -> DataFrame:
    """``apply`` for a composite grouping key (real columns only)."""
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=time_mode)
