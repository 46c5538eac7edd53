"""Curation report: drops and survivors from one small count table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import seeded_order
from millrace.functions.rounding import nearest_places


def reason_counts(judged: DataFrame) -> DataFrame:
    """Rows per (category, reason); the only pass over the data."""
    return judged.groupBy("category", "reason").agg(F.count(F.lit(1)).alias("n"))


def breakdown(counts: DataFrame) -> DataFrame:
    """Totals at three levels, (level, category, reason, n), from the count table."""
    sets = counts.groupingSets(
        [[], [F.col("reason")], [F.col("category"), F.col("reason")]], F.col("category"), F.col("reason")
    ).agg(F.sum("n").alias("n"), F.grouping("category").alias("_gc"), F.grouping("reason").alias("_gr"))
    level = (
        F.when(F.col("_gr") == 1, F.lit("all")).when(F.col("_gc") == 1, F.lit("reason")).otherwise(F.lit("category_reason"))
    )
    return sets.select(level.alias("level"), "category", "reason", "n")


def summary(counts: DataFrame) -> DataFrame:
    """Input rows, kept rows and the survival rate at three places."""
    total = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.coalesce(F.sum(F.when(F.col("reason") == "ok", F.col("n"))), F.lit(0))
    return counts.agg(total.alias("input_records"), kept.alias("kept")).withColumn(
        "survival_rate", nearest_places(F.col("kept") / F.greatest("input_records", F.lit(1)), 3)
    )


def kept_per_category(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("reason") == "ok").groupBy("category").agg(F.sum("n").alias("n"))


def review_sample(kept: DataFrame, rows: int = 50, seed: int = 42, row_id: str = "pos") -> DataFrame:
    """A reproducible random sample of kept rows for a person to read (a top-k by hashed id)."""
    return kept.orderBy(seeded_order(seed, F.col(row_id)), row_id).limit(rows)


def report_document(
    counts: DataFrame, entities: DataFrame, source_mode: str, columns: Sequence[str] = ("category", "reason")
) -> DataFrame:
    """The whole report as one nested row, for the JSON sink."""
    dropped = counts.where(F.col("reason") != "ok")

    def as_map(df: DataFrame, key: str, name: str) -> DataFrame:
        pairs = F.array_sort(F.collect_list(F.struct(F.col(key), F.col("n"))))
        return df.groupBy(key).agg(F.sum("n").alias("n")).agg(F.map_from_entries(pairs).alias(name))

    nested = (
        dropped.groupBy(*columns).agg(F.sum("n").alias("n")).groupBy("category")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("m"))
        .agg(F.map_from_entries(F.collect_list(F.struct("category", "m"))).alias("drops_by_category"))
    )
    found = entities.where((F.col("entity") != "records") & (F.col("n") > 0))
    scrubbed = entities.where(F.col("entity") == "records").agg(F.max("n").alias("records_with_pii_scrubbed"))
    one = (
        summary(counts)
        .withColumn("source_mode", F.lit(source_mode))
        .withColumn("_k", F.lit(1))
    )
    for part in (
        as_map(dropped, "reason", "drops"),
        scrubbed,
        as_map(found, "entity", "pii_entities_found"),
        as_map(counts.where(F.col("reason") == "ok"), "category", "categories_kept"),
        nested,
    ):
        one = one.join(part.withColumn("_k", F.lit(1)), "_k", "left")  # one row each
    return one.select(
        "source_mode", "input_records", "kept", "survival_rate", "drops",
        "records_with_pii_scrubbed", "pii_entities_found", "categories_kept", "drops_by_category",
    )
