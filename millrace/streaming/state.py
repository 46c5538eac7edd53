"""Keyed state on streams: quota, cache entries, alert holds, in event-time order.

Rows wait in the state until the watermark has passed them and are then handled
in time order (ties by id). So results depend neither on the order of files nor on how
rows are cut into chunks, and equal those of the batch operators for every row
the watermark has passed. A key holds the rows of the watermark's span. For the quota a key
is one of ``QUOTA_SHARES`` shares of all clients' minutes, decided for all of them at once, because a
call of Python for every minute of every client costs far more than the decisions. Rows later than the
watermark are dropped and counted by ``runner.late_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.streaming.runner import use_rocksdb

MICROS = 1_000_000
MINUTE_MS = 60_000
#: Quota keys; part of the state's layout, so a stream keeps it for life.
QUOTA_SHARES = 128


def _gathered(chunks: Iterator[pd.DataFrame], columns: list[str], held: list[list]) -> list[np.ndarray]:
    """Held values and those of all chunks, one array per column, sorted by the first two columns."""
    parts = [[list(h)] for h in held]
    for chunk in chunks:
        for part, column in zip(parts, columns):
            part.append(chunk[column].tolist())
    arrays = [np.array([v for p in part for v in p], dtype=np.int64) for part in parts]
    order = np.lexsort((arrays[1], arrays[0]))
    return [a[order] for a in arrays]


def quota_share() -> Column:
    """The state key of a request: clients' minutes are independent, so a busy client is spread over time."""
    return F.pmod(F.xxhash64("client", F.floor(F.col("t") / (60 * MICROS)).cast("long")), F.lit(QUOTA_SHARES)).cast("int")


def quota_decisions(t: np.ndarray, ids: np.ndarray, clients: np.ndarray, limit: int) -> pd.DataFrame:
    """Decisions for whole minutes of any number of clients; requests of a minute count in order of time, then id."""
    who, names = pd.factorize(clients, use_na_sentinel=False)
    order = np.lexsort((ids, t, who))
    who, minute, at = who[order], t[order] // (60 * MICROS), np.arange(len(t), dtype=np.int64)
    begins = np.ones(len(t), bool)
    begins[1:] = (who[1:] != who[:-1]) | (minute[1:] != minute[:-1])
    number = at - np.maximum.accumulate(np.where(begins, at, 0)) + 1
    return pd.DataFrame(
        {
            "request_id": ids[order],
            "client": names[who],
            "minute": minute,
            "request_no": number,
            "allowed": number <= limit,
            "remaining": np.maximum(0, limit - number),
        }
    )


def quota_stream(log: DataFrame, limit: int = 60, watermark: str = "5 minutes") -> DataFrame:
    """Quota decisions on a stream of (request_id, client, ts), those of a client's minute together when it is over.

    State: a share's requests of the minutes that aren't over.
    """
    use_rocksdb(log.sparkSession)
    keyed = log.withWatermark("ts", watermark).select("ts", "request_id", "client", F.unix_micros("ts").alias("t"))

    def count(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        t, ids, clients = (list(h) for h in state.get) if state.exists else ([], [], [])
        for chunk in chunks if not state.hasTimedOut else ():
            t += chunk["t"].tolist()
            ids += chunk["request_id"].tolist()
            clients += chunk["client"].tolist()
        rows = np.array(t, np.int64), np.array(ids, np.int64), np.array(clients, object)
        ends = (rows[0] // (60 * MICROS) + 1) * MINUTE_MS
        over = ends < state.getCurrentWatermarkMs()
        if over.any():
            yield quota_decisions(*(r[over] for r in rows), limit)
        if over.all():
            if state.exists:
                state.remove()
            return
        state.update(tuple(r[~over].tolist() for r in rows))
        state.setTimeoutTimestamp(int(ends[~over].min()))

    return keyed.withColumn("share", quota_share()).groupBy("share").applyInPandasWithState(
        count,
        outputStructType="request_id long, client string, minute long, request_no long, allowed boolean, remaining long",
        stateStructType="t array<long>, request_id array<long>, client array<string>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )


def cache_stream(log: DataFrame, ttl_s: int = 3600, watermark: str = "5 minutes") -> DataFrame:
    """Hit or miss on a stream of cacheable requests (request_id, cache_key, ts, stores).

    State: expiry of the entry, and the requests the watermark has not passed.
    """
    use_rocksdb(log.sparkSession)
    ttl = ttl_s * MICROS
    keyed = log.withWatermark("ts", watermark).select(
        "ts", "request_id", "cache_key", "stores", F.unix_micros("ts").alias("t")
    )

    def look_up(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        until, *held = state.get if state.exists else (None, [], [], [])
        passed = state.getCurrentWatermarkMs()
        rows = _gathered(chunks, ["t", "request_id", "stores"], held)
        ready = int(np.searchsorted(rows[0], passed * 1000, side="left"))
        t, ids, stores = (r[:ready] for r in rows)
        hit = np.zeros(ready, dtype=bool)
        at = 0
        while at < ready:
            if until is not None:
                end = int(np.searchsorted(t, until, side="left"))
                hit[at:end] = True
                at = max(at, end)
            later = np.flatnonzero(stores[at:])
            if len(later) == 0:
                break
            at += int(later[0])
            until = int(t[at]) + ttl
            at += 1
        if ready:
            yield pd.DataFrame({"request_id": ids, "cache_key": key[0], "cache_result": np.where(hit, "hit", "miss")})
        waiting = [r[ready:].tolist() for r in rows]
        # wake when the first waiting request may be handled, or when the entry is of no more use
        wake = waiting[0][0] // 1000 if waiting[0] else None if until is None else -(-until // 1000)
        if wake is None or (not waiting[0] and wake <= passed):
            if state.exists:
                state.remove()
            return
        state.update((until, *waiting))
        state.setTimeoutTimestamp(max(wake, passed + 1))

    return keyed.groupBy("cache_key").applyInPandasWithState(
        look_up,
        outputStructType="request_id long, cache_key string, cache_result string",
        stateStructType="until long, t array<long>, request_id array<long>, stores array<long>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )


def alert_stream(signals: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Firing alerts from a stream of (alert, minute, breached, hold_min), one row when a hold is complete.

    The input is per-minute signals, so its rate depends on the number of alerts
    and not on the traffic. State: start and last minute of the breach, whether it
    fired, and the minutes the watermark has not passed.
    """
    use_rocksdb(signals.sparkSession)
    keyed = signals.withWatermark("minute", watermark).select(
        "minute", "alert", F.floor(F.unix_micros("minute") / (60 * MICROS)).cast("long").alias("m"),
        F.col("breached").cast("long").alias("breached"), F.col("hold_min").cast("long").alias("hold_min"),
    )

    def hold(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        started, last, fired, *held = state.get if state.exists else (None, None, False, [], [], [])
        passed = state.getCurrentWatermarkMs()
        rows = _gathered(chunks, ["m", "breached", "hold_min"], held)
        ready = int(np.searchsorted(rows[0] * 60_000, passed, side="left"))
        out = []
        for m, breached, wait in zip(*(r[:ready].tolist() for r in rows)):
            if not breached:
                started, last, fired = None, None, False
                continue
            if started is None or m != last + 1:
                started, fired = m, False
            last = m
            if not fired and m - started >= wait:
                fired = True
                out.append((key[0], started, m))
        if out:
            yield pd.DataFrame(out, columns=["alert", "started_min", "fired_min"])
        waiting = [r[ready:].tolist() for r in rows]
        state.update((started, last, bool(fired), *waiting))
        if waiting[0]:
            state.setTimeoutTimestamp(max(waiting[0][0] * 60_000, passed + 1))

    return keyed.groupBy("alert").applyInPandasWithState(
        hold,
        outputStructType="alert string, started_min long, fired_min long",
        stateStructType="started long, last long, fired boolean, m array<long>, breached array<long>, hold_min array<long>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    ).select(
        "alert", F.timestamp_seconds(F.col("started_min") * 60).alias("started"),
        F.timestamp_seconds(F.col("fired_min") * 60).alias("fired_at"),
    )
