"""Observation job: counters, quantiles, gauges and alerts of one classified log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import AlertRules
from millrace.operators import metrics, retrieval

#: Outcomes of requests that asked the cache and did not find an answer.
LOOKED_UP = ("timeout", "unavailable", "engine_error", "output_blocked", "ok")


def observe(
    classified: DataFrame,
    readings: DataFrame | None = None,
    found: DataFrame | None = None,
    rules: AlertRules = AlertRules(),
) -> dict[str, DataFrame]:
    """Metric tables by name. ``classified`` comes from the traffic job and should be a written table.

    ``readings`` (ts, request_id, upstream, up) adds the gauge and its alert, ``found``
    (query_id, found) the retrieval counts. Token totals need prompt_tokens and completion_tokens.
    """
    observed = classified.where("latency_observed")
    counted = classified.where("counted").drop("variant").withColumnRenamed("label_variant", "variant")
    histogram = metrics.latency_histogram(observed, ["route", "variant"])
    result = F.when(F.col("outcome") == "cache_hit", "hit").when(F.col("outcome").isin(*LOOKED_UP), "miss")
    blocked = F.when(F.col("outcome") == "input_blocked", F.struct(F.lit("input").alias("stage"), F.col("input_reason").alias("reason"))).when(
        F.col("outcome") == "output_blocked", F.struct(F.lit("output").alias("stage"), F.col("output_reason").alias("reason"))
    )
    signals = metrics.alert_signals(classified, readings, rules)
    out = {
        "requests": metrics.request_counts(classified),
        "latency": histogram,
        "latency_quantiles": metrics.quantiles(histogram, ["route", "variant"], [0.5, 0.95, 0.99]),
        "rate_limited": metrics.label_counts(classified, ["route"], F.col("outcome") == "rate_limited"),
        "upstream_errors": metrics.label_counts(
            classified, [F.col("upstream_error").alias("kind")], F.col("upstream_error").isNotNull()
        ),
        "cache": metrics.cache_ratio(classified.withColumn("cache_result", result)),
        "blocks": metrics.label_counts(classified.select(blocked.alias("b")).where("b is not null").select("b.*"), ["stage", "reason"]),
        "rate_5m": metrics.rates(counted, ["variant", "http_status"], 5),
        "variants": metrics.variant_comparison(counted, "http_status"),
        "signals": signals,
        "alerts": metrics.firing(signals),
    }
    if {"prompt_tokens", "completion_tokens"} <= set(classified.columns):
        out["tokens"] = metrics.token_totals(classified.where("outcome = 'ok'"))
    if readings is not None:
        out["upstream"] = metrics.latest(readings, ["upstream"], "up")
    if found is not None:
        out["retrieval"] = retrieval.unknown_topic_rate(found)
    return out
