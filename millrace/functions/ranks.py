"""Exact ranks without sorting a whole group in one task.

A plain ``row_number`` over a group that holds a third of the table sorts that
third in one task. Both helpers first count rows in fine, ordered buckets of the
sort key (a map-side combined aggregate) and turn the counts into offsets, so a
task only ever sorts one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_row_number(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], out: str
) -> DataFrame:
    """``row_number`` over ``group`` where ``bucket`` is a coarse, order-preserving sort key.

    Rows shuffle once, on (group, bucket); the offsets come from a table with one
    row per bucket, joined on the same key so the shuffle is reused.
    """
    keys = [*group, bucket]
    running = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(k).alias(f"_at_{k}") for k in keys], F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before")
        )
    )
    same = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys]  # a null key is a group like any other
    inner = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(inner))
        .join(offsets, same)
        .withColumn(out, F.col("_before") + F.col("_rn"))
        .drop("_before", "_rn", *[f"_at_{k}" for k in keys])
    )


def keys_at_ranks(keys: DataFrame, group: Sequence[str], key: str, wanted: DataFrame) -> DataFrame:
    """The sort key at given ranks of each group.

    ``keys`` has the group columns and a hexadecimal hash ``key``; ``wanted`` has
    the group columns, ``name`` and ``rank`` (from 1). The result has ``cut``, the key,
    and ``at_cut``, how many rows with that very key lie within the rank. The first
    four digits cut the keys into 65,536 even buckets, and only the buckets that
    contain a wanted rank are sorted, each by its distinct keys.
    """
    group = list(group)
    bucketed = keys.select(*group, key, F.substring(key, 1, 4).alias("_b"))
    running = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    counts = bucketed.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    spans = counts.withColumn("_hi", F.sum("_n").over(running)).withColumn("_lo", F.col("_hi") - F.col("_n"))
    hit = (
        wanted.join(spans, group)
        .where((F.col("rank") > F.col("_lo")) & (F.col("rank") <= F.col("_hi")))
        .select(*group, "_b", "name", (F.col("rank") - F.col("_lo")).alias("_at"))
    )
    inner = Window.partitionBy(*group, "_b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    distinct = (
        bucketed.join(hit.select(*group, "_b").distinct(), [*group, "_b"], "left_semi")
        .groupBy(*group, "_b", key).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_to", F.sum("_n").over(inner))
    )
    return (
        distinct.join(hit, [*group, "_b"])
        .where((F.col("_at") <= F.col("_to")) & (F.col("_at") > F.col("_to") - F.col("_n")))
        .select(*group, "name", F.col(key).alias("cut"), (F.col("_at") - F.col("_to") + F.col("_n")).alias("at_cut"))
    )
