"""Quota and cache decisions from map and value state with event-time timers.

The same results as ``state.quota_stream`` and ``state.cache_stream``. There a key's state is one value that is
read and written as a whole whenever the key has rows; here rows wait in slots of time, so a batch reads and
writes only the slots it touches, a timer wakes a key when the watermark has passed something of it, and a
key whose last slot and last entry are over leaves no state.

Each access to the state is a message to the JVM, so a slot is an hour and not a minute: in a stream that keeps up, the
watermark's span alone waits in it, and a backlog of months needs few messages. Timers follow the earliest
row that waits, not the slot. Quota keys are shares of all clients' minutes, as in ``state.quota_stream``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming import state
from millrace.streaming.runner import use_rocksdb

SLOT_MS = 3_600_000
MICROS = 1_000_000
#: Decisions that make one output frame at least, if so many are due.
FRAME_ROWS = 10_000


def _slots(rows: Iterator[pd.DataFrame], columns: dict[str, type]) -> dict[int, list[list]]:
    """Rows by slot, one list per column; the first column is the time in microseconds."""
    chunks = [[chunk[name].to_numpy().astype(kind) for name, kind in columns.items()] for chunk in rows]
    arrays = [np.concatenate(parts) for parts in zip(*chunks)]
    slot = arrays[0] // (SLOT_MS * 1000)
    order = np.argsort(slot, kind="stable")
    found, at = np.unique(slot[order], return_index=True)
    parts = zip(*(np.split(a[order], at[1:]) for a in arrays))
    return {m: [p.tolist() for p in part] for m, part in zip(found.tolist(), parts)}


def _sorted(columns: list[list[int]]) -> list[np.ndarray]:
    """Columns in order of time, then id (the second column)."""
    arrays = [np.array(c, np.int64) for c in columns]
    order = np.lexsort((arrays[1], arrays[0]))
    return [a[order] for a in arrays]


class QuotaMinutes(StatefulProcessor):
    """Requests of a share of the clients' minutes wait until the watermark closes their minute."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot long", "t array<long>, request_id array<long>, client array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        wake = None
        for slot, columns in _slots(rows, {"t": np.int64, "request_id": np.int64, "client": object}).items():
            wake = self._end(min(columns[0])) if wake is None else wake
            if (old := self.waiting.getValue((slot,))) is not None:
                columns = [[*held, *new] for held, new in zip(old, columns)]
            self.waiting.updateValue((slot,), tuple(columns))
        if wake < min(self.handle.listTimers(), default=wake + 1):
            self.handle.registerTimer(wake)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        wake, due, n = None, [], 0
        for slot in sorted(m for (m,) in self.waiting.keys()):
            columns = self.waiting.getValue((slot,))
            rows = [np.array(c, kind) for c, kind in zip(columns, (np.int64, np.int64, object))]
            ends = self._end(rows[0])
            over = ends < passed
            if over.any():
                due.append([r[over] for r in rows])
                n += int(over.sum())
            if not over.all():
                wake = int(ends[~over].min())
                if over.any():
                    self.waiting.updateValue((slot,), tuple(r[~over].tolist() for r in rows))
            else:
                self.waiting.removeKey((slot,))
            if n and (n >= FRAME_ROWS or wake is not None):
                yield state.quota_decisions(*(np.concatenate(c) for c in zip(*due)), self.limit)
                due, n = [], 0
            if wake is not None:  # no minute of a later slot is over
                break
        if n:
            yield state.quota_decisions(*(np.concatenate(c) for c in zip(*due)), self.limit)
        for timer in list(self.handle.listTimers()):
            if timer > passed:
                self.handle.deleteTimer(timer)
        if wake is not None:
            self.handle.registerTimer(wake)

    @staticmethod
    def _end(t):
        """End of the minute, in milliseconds."""
        return (t // (60 * MICROS) + 1) * state.MINUTE_MS

    def close(self) -> None:
        pass


class CacheEntry(StatefulProcessor):
    """Expiry of a key's entry, and its requests that the watermark hasn't passed."""

    def __init__(self, ttl_s: int):
        self.ttl = ttl_s * MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot long", "t array<long>, request_id array<long>, stores array<long>")
        self.entry = handle.getValueState("entry", "until long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = _slots(rows, {"t": np.int64, "request_id": np.int64, "stores": np.int64})
        for slot, columns in fresh.items():
            if (old := self.waiting.getValue((slot,))) is not None:
                fresh[slot] = [[*held, *new] for held, new in zip(old, columns)]
        yield from self._pass(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._pass(key, {}, timerValues.getCurrentWatermarkInMs())

    def _pass(self, key: tuple, fresh: dict[int, list[list[int]]], passed: int) -> Iterator[pd.DataFrame]:
        """Looks up what lies before the watermark, slot by slot; ``fresh`` slots are whole, the others are in the state."""
        known = self.entry.get()
        until = known[0] if known else None
        stored = {m for (m,) in self.waiting.keys()}
        slots = sorted({*fresh, *stored})
        first = None  # the earliest request that still waits
        for slot in slots:
            if slot * SLOT_MS >= passed:
                if slot in fresh:
                    self.waiting.updateValue((slot,), tuple(fresh[slot]))
                if first is None:
                    first = min(fresh[slot][0] if slot in fresh else self.waiting.getValue((slot,))[0])
                continue
            columns = _sorted(fresh[slot] if slot in fresh else [list(c) for c in self.waiting.getValue((slot,))])
            ready = int(np.searchsorted(columns[0], passed * 1000, side="left"))
            hit, until = self._look_up(columns[0][:ready], columns[2][:ready], until)
            if ready:
                yield pd.DataFrame({"request_id": columns[1][:ready], "cache_key": key[0], "cache_result": np.where(hit, "hit", "miss")})
            if ready < len(columns[0]):
                self.waiting.updateValue((slot,), tuple(c[ready:].tolist() for c in columns))
                first = int(columns[0][ready]) if first is None else first
            elif slot in stored:
                self.waiting.removeKey((slot,))
        for timer in list(self.handle.listTimers()):
            if timer > passed:
                self.handle.deleteTimer(timer)
        if first is None and (until is None or until <= passed * 1000):
            self.entry.clear()
            return
        if until is not None and (not known or known[0] != until):
            self.entry.update((until,))
        # wake when the first waiting request may be handled, or when the entry is of no more use
        wake = first // 1000 if first is not None else -(-until // 1000)
        self.handle.registerTimer(max(wake, passed + 1))

    def _look_up(self, t: np.ndarray, stores: np.ndarray, until: int | None) -> tuple[np.ndarray, int | None]:
        hit, at = np.zeros(len(t), bool), 0
        while at < len(t):
            if until is not None:
                end = int(np.searchsorted(t, until, side="left"))
                hit[at:end] = True
                at = max(at, end)
            later = np.flatnonzero(stores[at:])
            if not len(later):
                break
            at += int(later[0])
            until = int(t[at]) + self.ttl
            at += 1
        return hit, until

    def close(self) -> None:
        pass


def quota_timers(log: DataFrame, limit: int = 60, watermark: str = "5 minutes") -> DataFrame:
    """Quota decisions on a stream of (request_id, client, ts), a client's minute at a time when it is over."""
    use_rocksdb(log.sparkSession)
    keyed = log.withWatermark("ts", watermark).select("ts", "request_id", "client", F.unix_micros("ts").alias("t"))
    shape = "request_id long, client string, minute long, request_no long, allowed boolean, remaining long"
    return keyed.withColumn("share", state.quota_share()).groupBy("share").transformWithStateInPandas(QuotaMinutes(limit), shape, "Append", "EventTime")


def cache_timers(log: DataFrame, ttl_s: int = 3600, watermark: str = "5 minutes") -> DataFrame:
    """Hit or miss on a stream of cacheable requests (request_id, cache_key, ts, stores)."""
    use_rocksdb(log.sparkSession)
    keyed = log.withWatermark("ts", watermark).select("ts", "request_id", "cache_key", "stores", F.unix_micros("ts").alias("t"))
    shape = "request_id long, cache_key string, cache_result string"
    return keyed.groupBy("cache_key").transformWithStateInPandas(CacheEntry(ttl_s), shape, "Append", "EventTime")
