"""Running a stream over files to its end, for backfills and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state lives in RocksDB, off the heap and checkpointed to the shared folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_files(spark: SparkSession, path: str, schema: str, name: str | None = None, files_per_batch: int = 1) -> DataFrame:
    """A file stream over ``path``; ``name`` restricts it to files of that name."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true")
    if name:
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def drain(stream: DataFrame, label: str, mode: str = "append") -> tuple[DataFrame, StreamingQuery]:
    """Process everything available and return the written table and the finished query."""
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{label}-progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), query


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped because they arrived after the watermark had passed them."""
    return sum(
        op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators
    )
