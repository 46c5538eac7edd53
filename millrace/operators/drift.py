"""Signals per model and the retrain policy over them."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import DriftPolicy
from millrace.functions import fixed
from millrace.operators.evaluation import percent

SIGNALS = (
    "golden_pass_rate", "baseline_pass_rate", "error_rate", "p95_latency_s", "new_labelled_examples", "unknown_topic_rate",
)


def assemble(
    pass_rates: DataFrame, errors: DataFrame, latency: DataFrame, new_examples: DataFrame, topics: DataFrame
) -> DataFrame:
    """One row of signals per model.

    ``pass_rates``: (model, golden_pass_rate, baseline_pass_rate); the others are
    one row per model with one signal each. A missing traffic signal counts as quiet.
    """
    out = pass_rates
    for part in (errors, latency, new_examples, topics):
        out = out.join(part, "model", "left")
    zero = F.lit(0.0)
    return out.select(
        "model",
        "golden_pass_rate",
        F.coalesce("baseline_pass_rate", "golden_pass_rate").alias("baseline_pass_rate"),
        F.coalesce("error_rate", zero).alias("error_rate"),
        F.coalesce("p95_latency_s", zero).alias("p95_latency_s"),
        F.coalesce("new_labelled_examples", F.lit(0)).cast("long").alias("new_labelled_examples"),
        F.coalesce("unknown_topic_rate", zero).alias("unknown_topic_rate"),
    )


def category_shift(
    before: DataFrame, after: DataFrame, by: Sequence[str] = ("model",), category: str = "category", smoothing: float = 0.5
) -> DataFrame:
    """(by, n_before, n_after, shift): how far the categories of the prompts moved between two windows of rows.

    ``shift`` is the Jensen-Shannon divergence in bits of the two category distributions: 0 for equal windows,
    1 at most. Every category seen in either window gets ``smoothing`` more rows in both, so that a rare new
    category moves it little. A null category is one of its own. Where one window has no rows the shift is null.
    """
    keys = list(by)
    counts = functools.reduce(
        DataFrame.unionByName,
        [
            window.groupBy(*keys, category).agg(*[F.count(F.lit(1) if i == j else F.lit(None)).alias(f"_n{j}") for j in (0, 1)])
            for i, window in enumerate((before, after))
        ],
    )
    cells = counts.groupBy(*keys, category).agg(F.sum("_n0").alias("_n0"), F.sum("_n1").alias("_n1"))
    totals = cells.groupBy(*keys).agg(
        F.sum("_n0").alias("n_before"), F.sum("_n1").alias("n_after"), F.count(F.lit(1)).alias("_c")
    ).select(*[F.col(k).alias(f"_t{k}") for k in keys], "n_before", "n_after", "_c")
    joined = cells.join(totals, [F.col(k).eqNullSafe(F.col(f"_t{k}")) for k in keys])
    p, q = ((F.col(c) + smoothing) / (F.col(t) + F.col("_c") * smoothing) for c, t in (("_n0", "n_before"), ("_n1", "n_after")))
    middle = (p + q) / 2
    terms = (p * F.log2(p / middle) + q * F.log2(q / middle)) / 2
    return joined.groupBy(*keys, "n_before", "n_after").agg(F.sum(terms).alias("_s")).select(
        *keys, "n_before", "n_after", F.when((F.col("n_before") > 0) & (F.col("n_after") > 0), F.greatest("_s", F.lit(0.0))).alias("shift")
    )


def decide(signals: DataFrame, policy: DriftPolicy = DriftPolicy()) -> DataFrame:
    """Add ``retrain``, ``severity`` and ``reasons``. Any threshold breach is urgent; new data alone is routine."""
    drop = F.col("baseline_pass_rate") - F.col("golden_pass_rate")
    quality = F.when(
        drop > policy.quality_drop, F.format_string(fixed.DRIFT_QUALITY, percent(F.col("golden_pass_rate")), percent(drop))
    )
    errors = F.when(
        F.col("error_rate") > policy.error_ceiling,
        F.format_string(fixed.DRIFT_ERRORS, percent(F.col("error_rate")), percent(F.lit(policy.error_ceiling))),
    )
    seconds = F.format_string("%.1f", F.bround("p95_latency_s", 1))
    limit = F.bround(F.lit(policy.latency_ceiling_s), 0).cast("int").cast("string")
    latency = F.when(F.col("p95_latency_s") > policy.latency_ceiling_s, F.format_string(fixed.DRIFT_LATENCY, seconds, limit))
    topics = F.when(
        F.col("unknown_topic_rate") > policy.unknown_topic_ceiling,
        F.format_string(fixed.DRIFT_TOPICS, percent(F.col("unknown_topic_rate"))),
    )
    breaches = F.col("_breaches")
    urgent: Column = F.size(breaches) > 0
    has_new = F.col("new_labelled_examples") >= policy.min_new_examples
    routine = F.format_string(fixed.DRIFT_ROUTINE, F.col("new_labelled_examples").cast("string"))
    return (
        signals.withColumn("_breaches", F.array_compact(F.array(quality, errors, latency, topics)))
        .withColumns(
            {
                "retrain": urgent | has_new,
                "severity": F.when(urgent, "urgent").when(has_new, "routine").otherwise("none"),
                "reasons": F.when(urgent, breaches).when(has_new, F.array(routine)).otherwise(
                    F.array(F.lit(fixed.SIGNALS_QUIET))
                ),
            }
        )
        .drop("_breaches")
    )
