"""Sinks: JSON lines, splits, one-document reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.runs import with_lineage


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, non-ASCII characters kept."""
    df.write.mode("errorifexists").json(path)


def write_splits(examples: DataFrame, path: str, seed: int = 42) -> None:
    """One folder per split, rows in seeded order within each file.

    Rows are ranged on (split, hash), so a split spreads over as many files as its size asks for.
    """
    from millrace.functions.hashing import seeded_order

    order = seeded_order(seed, F.col("id"))
    (
        examples.withColumn("_o", order)
        .repartitionByRange("split", "_o")
        .sortWithinPartitions("split", "_o")
        .select("split", "messages", "category")
        .write.mode("errorifexists").partitionBy("split").json(path)
    )


def write_report(one_row: DataFrame, path: str) -> None:
    """A one-row report as a single JSON document."""
    one_row.coalesce(1).write.mode("errorifexists").json(path)


def append_run(run: DataFrame, lineage: Mapping[str, object], path: str) -> None:
    """Append a run's row, with its lineage columns, to the runs table."""
    with_lineage(run, lineage).write.mode("append").parquet(path)
