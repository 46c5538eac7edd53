"""Windowed counters and screening on streams; late rows fall to the watermark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.guardrails import blocks, screen


def windowed_counts(
    stream: DataFrame, labels: Sequence[str], width: str, slide: str | None = None, watermark: str = "10 minutes", ts: str = "ts",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(window_start, window_end, labels, n, per_second) and ``extra`` aggregates; a window is emitted once the watermark closes it."""
    more = extra or {}
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = stream.withWatermark(ts, watermark).groupBy(window.alias("w"), *labels).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in more.items()]
    )
    seconds = F.unix_seconds("w.end") - F.unix_seconds("w.start")
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *labels, "n",
        (F.col("n") / seconds).alias("per_second"), *more,
    )


def screened(stream: DataFrame, message: str | None = None, answer: str | None = None) -> DataFrame:
    """Flagged rows only, for a quarantine sink; stateless."""
    flagged = screen(stream, message, answer)
    for name in ("input_reason", "output_reason"):
        if name not in flagged.columns:
            flagged = flagged.withColumn(name, F.lit(""))
    return blocks(flagged)


def block_rates(stream: DataFrame, width: str, message: str | None = None, answer: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    """Blocks by stage and reason per window."""
    return windowed_counts(screened(stream, message, answer), ["stage", "reason"], width, watermark=watermark)
