"""A sink with two outputs that a repeated batch replaces instead of adding to.

Every micro-batch owns one folder in each output, named by its batch id. A batch that was interrupted is
run again under the same id from the same input, and overwrites whatever it had left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.windows import screened


def _folder(root: str, output: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{output}/batch_id={batch_id}"


def write_blocks(flagged: DataFrame, batch_id: int, root: str, width: str, ts: str = "ts") -> None:
    """Flagged rows of one batch to ``quarantine``, then their counts by window, stage and reason to ``counts``.

    The counts are read off the rows just written, so texts are screened once.
    """
    spark = flagged.sparkSession
    rows = _folder(root, "quarantine", batch_id)
    flagged.write.mode("overwrite").parquet(rows)
    written = spark.read.schema(flagged.schema).parquet(rows)
    counts = written.groupBy(F.window(ts, width).alias("w"), "stage", "reason").agg(F.count(F.lit(1)).alias("n"))
    narrow = counts.select(F.col("w.start").alias("window_start"), "stage", "reason", "n")
    narrow.coalesce(1).write.mode("overwrite").parquet(_folder(root, "counts", batch_id))


def quarantine(
    stream: DataFrame, root: str, progress: str, width: str = "5 minutes", message: str | None = None, answer: str | None = None,
    ts: str = "ts", write: Callable[..., None] = write_blocks,
) -> StreamingQuery:
    """Screens a stream with everything that is available and waits; ``root`` and ``progress`` may be those of a stopped run."""
    query = (
        screened(stream, message, answer)
        .writeStream.foreachBatch(lambda flagged, batch_id: write(flagged, batch_id, root, width, ts))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """All flagged rows so far, with the batch they came in."""
    return spark.read.parquet(f"{root.rstrip('/')}/quarantine")


def block_counts(spark: SparkSession, root: str) -> DataFrame:
    """(window_start, stage, reason, n): counts of all batches added up, so a window may be fed by several; late rows count."""
    parts = spark.read.parquet(f"{root.rstrip('/')}/counts")
    return parts.groupBy("window_start", "stage", "reason").agg(F.sum("n").alias("n"))
