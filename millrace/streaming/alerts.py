"""All alerts from one stream of classified requests and gauge readings.

Two stateful operators in one query. The first counts each minute (in the JVM, combined before the
shuffle) and passes a minute on when the watermark has closed it. The second has one row a minute and
series: it keeps the minutes of the rate window, the gauge's last reading and each alert's unbroken breach,
and evaluates every minute up to the watermark, by a timer where no row comes. So the state of the second
operator depends on the width of the window and not on the traffic or the watermark's delay.

Results equal the batch operators' (``metrics.alert_signals`` and ``metrics.firing``) for all minutes the
watermark has passed. Rows behind the watermark are dropped and counted by ``runner.late_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.config import AlertRules
from millrace.functions import fixed
from millrace.streaming.runner import use_rocksdb

MINUTE_MS = 60_000
EDGES = (*fixed.LATENCY_BOUNDS, float("inf"))
COUNTS = ("n", "bad", "canary_n", "canary_bad", *(f"b{i}" for i in range(len(EDGES))))


def bucket_quantile(counts: Sequence[int], q: float, edges: Sequence[float] = EDGES) -> float | None:
    """Quantile of a cumulative histogram, linear inside its bucket; None without observations."""
    if not counts[-1]:
        return None
    rank, below, start = q * counts[-1], 0, 0.0
    for edge, n in zip(edges, counts):
        if n >= rank:
            if edge == float("inf"):
                return start
            return start + (edge - start) * (rank - below) / (n - below) if n > below else None
        below, start = n, edge
    return None


def minute_stream(log: DataFrame, series: str, watermark: str) -> DataFrame:
    """Counts and the last gauge reading of each closed minute and series.

    ``log`` has ts, request_id, counted, http_status, label_variant, latency_observed, latency_s and up (null
    where the row is no reading).
    """
    counted = F.col("counted")
    failed, canary = F.col("http_status").between(500, 599), F.col("label_variant") == "canary"
    seen = counted & F.col("latency_observed")
    parts = {
        "n": counted, "bad": counted & failed, "canary_n": counted & canary, "canary_bad": counted & canary & failed,
        **{f"b{i}": seen & (F.col("latency_s") <= F.lit(float(b))) for i, b in enumerate(EDGES)},
    }
    reading = F.when(F.col("up").isNotNull(), F.struct("ts", "request_id"))
    minutes = log.withWatermark("ts", watermark).groupBy(series, F.window("ts", "1 minute").alias("w")).agg(
        *[F.count_if(c).alias(name) for name, c in parts.items()], F.max_by("up", reading).alias("up")
    )
    start = F.floor(F.unix_micros("w.start") / (1000 * MINUTE_MS)).cast("long").alias("minute")
    return minutes.select(series, F.window_time("w").alias("at"), start, F.array(*COUNTS).alias("counts"), F.col("up").cast("long").alias("up"))


class AlertHold(StatefulProcessor):
    """Rolls minutes up to signals and holds breaches; one instance a task, one state a series."""

    def __init__(self, rules: AlertRules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "minute long", "counts array<long>, up long")
        self.breaches = handle.getMapState("breaches", "alert string", "started long, last long, fired boolean")
        self.mark = handle.getValueState("mark", "evaluated long, gauge long, newest long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        evaluated, gauge, newest = self.mark.get() or (None, None, None)
        fresh: dict[int, tuple[list[int], int | None]] = {}
        for chunk in rows:
            for minute, counts, up in zip(chunk["minute"].tolist(), chunk["counts"].tolist(), chunk["up"].tolist()):
                known = None if up is None or up != up else int(up)
                fresh[minute] = [int(c) for c in counts], known
        evaluated = min(fresh) if evaluated is None else evaluated
        newest = max(fresh) if newest is None else max(newest, *fresh)
        yield from self._evaluate(key, fresh, evaluated, gauge, newest, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        evaluated, gauge, newest = self.mark.get()
        yield from self._evaluate(key, {}, evaluated, gauge, newest, timerValues.getCurrentWatermarkInMs())

    def _evaluate(
        self, key: tuple, fresh: dict, evaluated: int, gauge: int | None, newest: int, passed_ms: int
    ) -> Iterator[pd.DataFrame]:
        """Every minute after ``evaluated`` up to the watermark; a minute's own rows count from the next one on."""
        width, upto = self.rules.rate_window_min, passed_ms // MINUTE_MS
        stored = {m: value for (m,), value in self.minutes.iterator()}
        held = stored | fresh
        breaches = {a: tuple(value) for (a,), value in self.breaches.iterator()}
        before, out = dict(breaches), []
        now = evaluated + 1
        while now <= upto:
            rows = [held[m] for m in range(now - width, now) if m in held]
            if now - 1 in held and held[now - 1][1] is not None:
                gauge = held[now - 1][1]
            for alert, minute, breached, hold in self._signals(rows, now, gauge):
                self._hold(breaches, out, alert, minute, breached, hold)
            now += 1
        for minute in held:  # only minutes of windows still to be evaluated are kept
            if minute > upto - width:
                if minute in fresh:
                    self.minutes.updateValue((minute,), fresh[minute])
            elif minute in stored:
                self.minutes.removeKey((minute,))
        for alert in before.keys() - breaches.keys():
            self.breaches.removeKey((alert,))
        for alert, value in breaches.items():
            if before.get(alert) != value:
                self.breaches.updateValue((alert,), value)
        evaluated = max(evaluated, upto)
        self.mark.update((evaluated, gauge, newest))
        # minutes without rows still end windows and prolong a breach of the gauge
        if evaluated < newest + width or gauge == 0:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((evaluated + 1) * MINUTE_MS)
        if out:
            yield pd.DataFrame([(key[0], *row) for row in out], columns=["series", "alert", "started_min", "fired_min"])

    def _signals(self, rows: list, now: int, gauge: int | None) -> Iterator[tuple[str, int, bool | None, int]]:
        """(alert, minute, breached or None without a value, hold) at the end of the minute before ``now``."""
        rules, sums = self.rules, [sum(c) for c in zip(*(r[0] for r in rows))]
        if sums and sums[0]:
            n, bad, canary_n, canary_bad, *hist = sums
            yield "HighErrorRate", now, bad / n > rules.error_share, rules.error_hold_min
            yield "CanaryErrorsHigh", now, canary_n > 0 and canary_bad / canary_n > rules.canary_share, rules.canary_hold_min
            p95 = bucket_quantile(hist, 0.95)
            yield "HighLatencyP95", now, None if p95 is None else p95 > rules.p95_s, rules.p95_hold_min
        else:
            for alert in ("HighErrorRate", "CanaryErrorsHigh", "HighLatencyP95"):
                yield alert, now, None, 0
        yield "UpstreamDown", now - 1, None if gauge is None else gauge == 0, rules.upstream_hold_min

    @staticmethod
    def _hold(breaches: dict, out: list, alert: str, minute: int, breached: bool | None, hold: int) -> None:
        if not breached:
            breaches.pop(alert, None)
            return
        started, _, fired = breaches.get(alert, (minute, minute, False))
        if not fired and minute - started >= hold:
            fired = True
            out.append((alert, started, minute))
        breaches[alert] = (started, minute, fired)

    def close(self) -> None:
        pass


def alerts_of_log(log: DataFrame, rules: AlertRules = AlertRules(), watermark: str = "10 minutes", series: str = "series") -> DataFrame:
    """(series, alert, started, fired_at) from a stream of requests and readings, one row when a hold is complete."""
    use_rocksdb(log.sparkSession)
    fired = minute_stream(log, series, watermark).groupBy(series).transformWithStateInPandas(
        AlertHold(rules), "series string, alert string, started_min long, fired_min long", "Append", "EventTime"
    )
    return fired.select(
        F.col("series").alias(series), "alert", F.timestamp_seconds(F.col("started_min") * 60).alias("started"),
        F.timestamp_seconds(F.col("fired_min") * 60).alias("fired_at"),
    )
