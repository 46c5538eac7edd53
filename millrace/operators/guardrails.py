"""Screening of requests and answers by fixed patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.barrier import computed_once

UNICODE = "(?U)"


def input_reason(message: Column) -> Column:
    """First reason to refuse a message, or the empty string."""
    injection = UNICODE + "(?:" + "|".join(f"(?:{p})" for p in fixed.INJECTION_PATTERNS) + ")"
    reason = F.when(F.regexp_like(F.lower(message), F.lit(injection)), F.lit("prompt_injection"))
    for kind, pattern in fixed.REQUEST_PII_PATTERNS:
        hit = F.regexp_like(message, F.lit(UNICODE + pattern))
        if kind == "email":
            hit = F.contains(message, F.lit("@")) & hit
        reason = reason.when(hit, F.lit(f"pii_{kind}"))
    return reason.otherwise(F.lit(""))


def output_reason(answer: Column) -> Column:
    """``banned_placeholder`` if an answer holds a scrubbing placeholder, else the empty string."""
    hit = F.lit(False)
    for p in fixed.BANNED_PLACEHOLDERS:
        hit = hit | F.contains(answer, F.lit(p))
    return F.when(hit, F.lit("banned_placeholder")).otherwise(F.lit(""))


def screen(df: DataFrame, message: str | None = None, answer: str | None = None) -> DataFrame:
    """Add ``input_reason`` and/or ``output_reason``; works on tables and streams."""
    added = {}
    if message:
        added["input_reason"] = input_reason(F.coalesce(F.col(message), F.lit("")))
    if answer:
        added["output_reason"] = output_reason(F.coalesce(F.col(answer), F.lit("")))
    return computed_once(df, added)


def blocks(screened: DataFrame) -> DataFrame:
    """One row per block, (stage, reason); an answer only exists if its request passed."""
    return screened.select(
        "*",
        F.when(F.col("input_reason") != "", F.struct(F.lit("input").alias("stage"), F.col("input_reason").alias("reason")))
        .when(F.col("output_reason") != "", F.struct(F.lit("output").alias("stage"), F.col("output_reason").alias("reason")))
        .alias("_b"),
    ).where(F.col("_b").isNotNull()).select("*", "_b.stage", "_b.reason").drop("_b")


def block_counts(screened: DataFrame) -> DataFrame:
    return blocks(screened).groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"))
