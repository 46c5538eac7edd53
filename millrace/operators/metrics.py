"""Counters, latency histograms and quantiles, windowed rates, alerts over a classified request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.config import AlertRules
from millrace.functions import fixed

INF = float("inf")


def request_counts(log: DataFrame) -> DataFrame:
    """Requests by (route, status, variant); uncounted outcomes are left out."""
    return (
        log.where("counted")
        .groupBy("route", F.col("http_status").alias("status"), F.col("label_variant").alias("variant"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_counts(log: DataFrame, labels: Sequence[str], where: Column | None = None) -> DataFrame:
    """A counter with labels: rows per label combination."""
    kept = log if where is None else log.where(where)
    return kept.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def latency_histogram(
    log: DataFrame, labels: Sequence[str], value: str = "latency_s", bounds: Sequence[float] = fixed.LATENCY_BOUNDS
) -> DataFrame:
    """Cumulative histogram: (labels, le, n) with n = observations <= le, +Inf last.

    One conditional count per bound, all in one combining aggregate; the few
    result columns are then turned into rows.
    """
    edges = [*bounds, INF]
    counts = log.groupBy(*labels).agg(
        *[F.count_if(F.col(value) <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(edges)]
    )
    rows = F.array(
        *[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(edges)]
    )
    return counts.select(*labels, F.explode(rows).alias("h")).select(*labels, "h.le", "h.n")


def quantiles(histogram: DataFrame, labels: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(labels, q, value): linear interpolation inside the bucket that holds the rank.

    The lowest bucket starts at 0; a rank beyond the last finite bound gives that
    bound; an empty histogram gives null. Works on one row per bound, not on the log.
    """
    key = list(labels)
    order = Window.partitionBy(*key).orderBy("le") if key else Window.orderBy("le")
    whole = Window.partitionBy(*key) if key else Window.partitionBy(F.lit(1))
    b = histogram.select(
        *key, "le", "n",
        F.coalesce(F.lag("n").over(order), F.lit(0)).alias("_below"),
        F.coalesce(F.lag("le").over(order), F.lit(0.0)).alias("_from"),
        F.max("n").over(whole).alias("_total"),
    )
    wanted = b.select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    rank = F.col("q") * F.col("_total")
    inside = wanted.where((F.col("n") >= rank) & (F.col("_total") > 0)).groupBy(*key, "q").agg(
        F.min_by(F.struct("le", "n", "_below", "_from", "_total"), "le").alias("s")
    )
    s = "s."
    value = F.when(F.col(s + "le") == INF, F.col(s + "_from")).otherwise(
        F.col(s + "_from")
        + (F.col(s + "le") - F.col(s + "_from"))
        * F.try_divide(F.col("q") * F.col(s + "_total") - F.col(s + "_below"), F.col(s + "n") - F.col(s + "_below"))
    )
    return inside.select(*key, "q", value.alias("value"))


def cache_ratio(log: DataFrame, result: str = "cache_result") -> DataFrame:
    """One row: hits, misses, hit ratio (null without lookups)."""
    return log.where(F.col(result).isNotNull()).agg(
        F.count_if(F.col(result) == "hit").alias("hits"),
        F.count_if(F.col(result) == "miss").alias("misses"),
    ).withColumn("hit_ratio", F.try_divide(F.col("hits").cast("double"), F.col("hits") + F.col("misses")))


def token_totals(log: DataFrame) -> DataFrame:
    """Tokens by (kind, variant) from ``prompt_tokens`` and ``completion_tokens``."""
    wide = log.groupBy("variant").agg(
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion"),
    )
    return wide.unpivot("variant", ["prompt", "completion"], "kind", "tokens")


def _last(value: str, ts: str, row_id: str) -> Column:
    """The value of the latest row; of rows of the same time, that with the largest id."""
    return F.max_by(value, F.struct(ts, row_id))


def latest(readings: DataFrame, labels: Sequence[str], value: str, ts: str = "ts", row_id: str = "request_id") -> DataFrame:
    """Gauge: the value of the latest reading per label combination."""
    return readings.groupBy(*labels).agg(_last(value, ts, row_id).alias(value))


def minute_counts(log: DataFrame, labels: Sequence[str], ts: str = "ts") -> DataFrame:
    """Rows per minute and label combination, the base of all windowed rates."""
    return log.groupBy(F.date_trunc("minute", ts).alias("minute"), *labels).agg(F.count(F.lit(1)).alias("n"))


def sliding(minutes: DataFrame, labels: Sequence[str], width_min: int, sums: Sequence[str] = ("n",)) -> DataFrame:
    """Sums over windows of ``width_min`` minutes that end on each minute, (labels, window_end, sums).

    Each minute's small count row, not each log row, is repeated for the windows it is part of.
    """
    ends = F.explode(
        F.sequence(
            F.col("minute") + F.expr("INTERVAL 1 MINUTE"), F.col("minute") + F.expr(f"INTERVAL {int(width_min)} MINUTE"),
            F.expr("INTERVAL 1 MINUTE"),
        )
    )
    return minutes.select(*labels, ends.alias("window_end"), *sums).groupBy(*labels, "window_end").agg(
        *[F.sum(s).alias(s) for s in sums]
    )


def rates(log: DataFrame, labels: Sequence[str], width_min: int, ts: str = "ts") -> DataFrame:
    """Per-second rates over sliding windows, (labels, window_end, n, per_second)."""
    windows = sliding(minute_counts(log, labels, ts), labels, width_min)
    return windows.withColumn("per_second", F.col("n") / (60.0 * width_min))


def error_shares(log: DataFrame, by: Sequence[str] = (), status: str = "status") -> DataFrame:
    """Requests and shares of 4xx and 5xx per label combination."""
    out = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col(status).between(400, 499)).alias("client_errors"),
        F.count_if(F.col(status).between(500, 599)).alias("server_errors"),
    )
    return out.withColumns(
        {
            "client_error_share": F.try_divide(F.col("client_errors").cast("double"), F.col("requests")),
            "server_error_share": F.try_divide(F.col("server_errors").cast("double"), F.col("requests")),
        }
    )


def variant_comparison(log: DataFrame, status: str = "status") -> DataFrame:
    """Stable against canary in one row: requests and share of server errors of each."""
    shares = error_shares(log, ["variant"], status).withColumn("_k", F.lit(1))
    return (
        shares.groupBy("_k")
        .pivot("variant", ["stable", "canary"])
        .agg(F.max("requests").alias("requests"), F.max("server_error_share").alias("server_error_share"))
        .drop("_k")
    )


# ---------------------------------------------------------------- alerts


def alert_signals(classified: DataFrame, readings: DataFrame | None = None, rules: AlertRules = AlertRules()) -> DataFrame:
    """(alert, minute, value, breached, hold_min) for every minute with a value.

    ``classified`` is a classified log with ts and latency_s: shares are of counted requests,
    latency is that of observed ones. ``readings`` has ts, up, request_id; a reading holds until
    the next one. Everything is derived from per-minute counts.
    """
    width = rules.rate_window_min
    is_canary = F.col("label_variant") == "canary"
    failed = F.col("http_status").between(500, 599)
    edges = [*fixed.LATENCY_BOUNDS, INF]
    minutes = classified.where("counted").groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(failed).alias("bad"),
        F.count_if(is_canary).alias("canary_n"),
        F.count_if(failed & is_canary).alias("canary_bad"),
        *[F.count_if(F.col("latency_observed") & (F.col("latency_s") <= F.lit(float(b)))).alias(f"b{i}") for i, b in enumerate(edges)],
    )
    sums = ["n", "bad", "canary_n", "canary_bad", *[f"b{i}" for i in range(len(edges))]]
    windows = sliding(minutes, [], width, sums).withColumnRenamed("window_end", "minute")

    def signal(name: str, value: Column, limit: float, hold: int) -> Column:
        return F.struct(
            F.lit(name).alias("alert"), value.alias("value"),
            F.coalesce(value > limit, F.lit(False)).alias("breached"), F.lit(hold).alias("hold_min"),
        )

    share = F.try_divide(F.col("bad").cast("double"), F.col("n"))
    canary_share = F.try_divide(F.col("canary_bad").cast("double"), F.col("canary_n"))
    from_log = windows.select(
        "minute",
        F.explode(
            F.array(
                signal("HighErrorRate", share, rules.error_share, rules.error_hold_min),
                signal("CanaryErrorsHigh", canary_share, rules.canary_share, rules.canary_hold_min),
            )
        ).alias("s"),
    ).select("s.alert", "minute", "s.value", "s.breached", "s.hold_min")
    histogram = windows.select(
        "minute",
        F.explode(
            F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(edges)])
        ).alias("h"),
    ).select("minute", "h.le", "h.n")
    p95 = quantiles(histogram, ["minute"], [0.95]).select(
        F.lit("HighLatencyP95").alias("alert"), "minute", "value",
        F.coalesce(F.col("value") > rules.p95_s, F.lit(False)).alias("breached"), F.lit(rules.p95_hold_min).alias("hold_min"),
    )
    out = from_log.unionByName(p95)
    if readings is not None:
        up = _held(readings, windows)
        out = out.unionByName(
            up.select(
                F.lit("UpstreamDown").alias("alert"), "minute", "value", (F.col("value") == 0).alias("breached"),
                F.lit(rules.upstream_hold_min).alias("hold_min"),
            )
        )
    return out


def _held(readings: DataFrame, windows: DataFrame) -> DataFrame:
    """(minute, value): the last reading of each minute, carried on to the next one and to the end of the log.

    One row per minute with a reading is ordered, whatever the traffic.
    """
    each = readings.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(
        _last("up", "ts", "request_id").cast("double").alias("value")
    )
    end = windows.agg(F.max("minute").alias("minute")).select("minute", F.lit(None).cast("double").alias("value"))
    marks = each.unionByName(end.where("minute is not null")).groupBy("minute").agg(F.max("value").alias("value"))
    order = Window.orderBy("minute")
    minute = F.expr("INTERVAL 1 MINUTE")
    held = marks.select(
        "minute", F.last("value", ignorenulls=True).over(order).alias("value"), F.lead("minute").over(order).alias("_next")
    ).where("value is not null")
    upto = F.coalesce(F.col("_next") - minute, F.col("minute"))
    return held.select(F.explode(F.sequence("minute", upto, minute)).alias("minute"), "value")


def firing(signals: DataFrame) -> DataFrame:
    """Stretches of unbroken breach that lasted the whole hold: (alert, started, ended, fired_at).

    Minutes without a value break a stretch. The series has one row per alert and
    minute whatever the traffic, so ordering it is cheap.
    """
    order = Window.partitionBy("alert").orderBy("minute")
    epoch = F.floor(F.unix_micros("minute") / 60_000_000)
    runs = signals.where("breached").withColumn("_island", epoch - F.row_number().over(order))
    spans = runs.groupBy("alert", "_island", "hold_min").agg(
        F.min("minute").alias("started"), F.max("minute").alias("ended")
    )
    fired_at = F.col("started") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("hold_min"))
    return spans.select("alert", "started", "ended", fired_at.alias("fired_at")).where(F.col("ended") >= F.col("fired_at"))
