"""Quantiles of values: exact by radix counting, and approximate from sketches that merge.

Exact: a double is turned into a whole number of the same order, and the wanted ranks are followed down
its digits. Each round counts the values per next digit, only in the buckets a rank fell into, so counts and
never values are gathered, whatever one group holds. When what is left is little, its different values are counted.

Sketches: a summary per minute, added up for windows of any length. Their rank error is stated, not their
error in value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

#: Bits of the digits, from the top; the numbers are below 2**63 in size.
DIGITS = (51, 38, 25, 12, 0)
#: Rows left in all wanted buckets from which on their different values are counted at once.
SETTLED = 200_000
MANTISSA = 1 << 52


def ordered_bits(value: Column) -> Column:
    """A long in the order of the doubles, equal for equal ones: exponent and mantissa, negative for negative values.

    NaN is the largest value and both zeros are one, as everywhere in Spark.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")
    # the logarithm may be off by one next to a power of two
    exponent = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    normal = F.greatest(exponent, F.lit(-1022))
    # halves of the power keep the quotient within range for the smallest and the largest values
    half = F.floor(normal / 2).cast("int")
    scaled = size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), normal - half)
    bits = (normal + 1023).cast("long") * MANTISSA + (scaled * float(MANTISSA)).cast("long") - MANTISSA
    top = 2047 * MANTISSA
    whole = F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(top).cast("long")).otherwise(bits)
    return F.when(F.isnan(value), F.lit(top + 1).cast("long")).when(value < 0, -whole).otherwise(whole)


def _wanted(totals: DataFrame, qs: Sequence[float]) -> DataFrame:
    """Ranks from 1 per group and q: ``disc`` of the smallest value that reaches the share, ``lo`` and ``hi`` around it."""
    each = totals.select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    n = F.col("_n").cast("double")
    place = (n - 1) * F.col("q")
    return each.withColumns(
        {
            "disc": F.greatest(n - F.floor(n - F.col("q") * n), F.lit(1)).cast("long"),
            "lo": F.floor(place) + 1, "hi": F.ceil(place) + 1, "part": place - F.floor(place),
        }
    )


def exact_quantiles(rows: DataFrame, labels: Sequence[str], qs: Sequence[float], value: str = "latency_s", settled: int = SETTLED) -> DataFrame:
    """(labels, q, n, disc, cont): exact order statistics of the values of each label combination.

    ``disc`` is the smallest value that at least the share q of all values doesn't exceed; ``cont`` interpolates
    between the values around (n - 1) * q. Null values are left out; a group without values has no row. Null
    labels are a group like any other.
    """
    keys = [f"_k{i}" for i in range(len(labels))]
    narrow = rows.where(F.col(value).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(labels, keys)], F.col(value).cast("double").alias("_v")
    )
    narrow = materialize(narrow.withColumn("_b", ordered_bits(F.col("_v"))), "quantile-values")
    totals = materialize(narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "quantile-totals")
    asked = _wanted(totals, qs)
    ranks = asked.select(*keys, F.explode(F.array("disc", "lo", "hi")).alias("rank")).distinct()
    # a rank's bucket is the digits above ``shift``; ``at`` is the rank within the bucket
    ranks = materialize(ranks.select(*keys, "rank", F.lit(0).cast("long").alias("bucket"), F.col("rank").alias("at")), "quantile-ranks")
    shift, left = 63, totals.agg(F.sum("_n")).first()[0] or 0
    for low in DIGITS:
        inside = _inside(narrow, ranks, keys, shift)
        if low == 0 or left <= settled:
            break
        digit = F.shiftright("_b", low).alias("_d")
        counts = inside.groupBy(*keys, "bucket", digit).agg(F.count(F.lit(1)).alias("_n"))
        found = _descended(ranks, counts, keys)
        ranks = materialize(found.select(*keys, "rank", F.col("_d").alias("bucket"), "at", "_n"), "quantile-ranks")
        left = ranks.select(*keys, "bucket", "_n").distinct().agg(F.sum("_n")).first()[0]
        ranks, shift = ranks.drop("_n"), low
    counts = inside.groupBy(*keys, "bucket", F.col("_b").alias("_d")).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"))
    values = materialize(_descended(ranks, counts, keys, "_v").select(*keys, "rank", "_v"), "quantile-found")

    def at(name: str) -> DataFrame:
        return values.select(*[F.col(k).alias(f"{name}{k}") for k in keys], F.col("rank").alias(f"_{name}"), F.col("_v").alias(f"_{name}_v"))

    out = asked
    for name in ("disc", "lo", "hi"):
        same = [F.col(k).eqNullSafe(F.col(f"{name}{k}")) for k in keys]
        out = out.join(at(name), [*same, F.col(name) == F.col(f"_{name}")])
    cont = F.when(F.col("_lo_v") == F.col("_hi_v"), F.col("_lo_v")).otherwise(F.col("_lo_v") + (F.col("_hi_v") - F.col("_lo_v")) * F.col("part"))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(labels, keys)], "q", F.col("_n").alias("n"), F.col("_disc_v").alias("disc"), cont.alias("cont")
    )


def _inside(narrow: DataFrame, ranks: DataFrame, keys: Sequence[str], shift: int) -> DataFrame:
    """The values in the buckets of the wanted ranks: a written table of at most three rows per group and q."""
    if shift == 63:
        return narrow.withColumn("bucket", F.lit(0).cast("long"))
    held = ranks.select(*[F.col(k).alias(f"_r{k}") for k in keys], "bucket").distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys]
    return narrow.join(held, [*same, F.shiftright("_b", shift) == F.col("bucket")]).drop(*[f"_r{k}" for k in keys])


def _descended(ranks: DataFrame, counts: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """Every wanted rank with the next digit ``_d`` of its bucket, its count ``_n`` and its place ``at`` among them."""
    running = Window.partitionBy(*keys, "bucket").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("_to", F.sum("_n").over(running)).select(
        *[F.col(k).alias(f"_c{k}") for k in keys], F.col("bucket").alias("_bucket"), "_d", "_n", "_to", *more
    )
    same = [F.col(k).eqNullSafe(F.col(f"_c{k}")) for k in keys]
    hit = ranks.join(ends, [*same, F.col("bucket") == F.col("_bucket")])
    within = (F.col("at") <= F.col("_to")) & (F.col("at") > F.col("_to") - F.col("_n"))
    return hit.where(within).withColumn("at", F.col("at") - F.col("_to") + F.col("_n"))


# ---------------------------------------------------------------- sketches

RANK_ERROR = 0.02


def sketch_size(rank_error: float = RANK_ERROR) -> int:
    """Size parameter of a sketch whose usual (99 %) rank error is half of ``rank_error``, which leaves it room.

    A KLL sketch of size k has a rank error of about 2.296 / k ** 0.9021, merged or not.
    """
    return min(65_535, max(8, math.ceil((2.296 / (rank_error / 2)) ** (1 / 0.9021))))


def minute_sketches(
    log: DataFrame, labels: Sequence[str], value: str = "latency_s", ts: str = "ts", rank_error: float = RANK_ERROR
) -> DataFrame:
    """(minute, labels, n, sketch): a mergeable summary of each minute's values; combined before the shuffle."""
    held = log.where(F.col(value).isNotNull() & ~F.isnan(value))
    return held.groupBy(F.date_trunc("minute", ts).alias("minute"), *labels).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(sketch_size(rank_error))).alias("sketch")
    )


def merged(sketches: DataFrame, by: Sequence[str], rank_error: float = RANK_ERROR) -> DataFrame:
    """Sketches added up per ``by``."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(sketch_size(rank_error))).alias("sketch")
    )


def sliding_sketches(minutes: DataFrame, labels: Sequence[str], width_min: int, rank_error: float = RANK_ERROR) -> DataFrame:
    """(labels, window_end, n, sketch) of windows of ``width_min`` minutes that end on each minute, from minute sketches."""
    step = F.expr("INTERVAL 1 MINUTE")
    ends = F.explode(F.sequence(F.col("minute") + step, F.col("minute") + F.expr(f"INTERVAL {int(width_min)} MINUTE"), step))
    return merged(minutes.withColumn("window_end", ends), [*labels, "window_end"], rank_error)


def sketch_quantiles(sketches: DataFrame, qs: Sequence[float]) -> DataFrame:
    """One row per sketch and q with the estimated ``value``."""
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value")) for q in qs]))
    return sketches.withColumn("_e", each).select("*", "_e.q", "_e.value").drop("_e", "sketch")
