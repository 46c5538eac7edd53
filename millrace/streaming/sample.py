"""A capped corpus sample kept while files arrive.

The cap takes the rows with the smallest seeded hash, and the smallest of all rows are the smallest of those kept so
far and the new ones. So the state is the sample itself: every micro-batch writes the sample after it under its batch
id, from the one before and its own rows. A batch that is run again overwrites its own sample from the same two inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.config import IngestRules
from millrace.sources import readers


def _state(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/sample-{batch_id}"


def write_sample(rows: DataFrame, batch_id: int, root: str, source: str, rules: IngestRules) -> None:
    """The corpus sample of all rows up to this batch."""
    pairs = readers.read_corpus(rows, source, rules)
    if batch_id:
        before = rows.sparkSession.read.schema(pairs.schema).parquet(_state(root, batch_id - 1))
        pairs = readers.seeded_cap(before.unionByName(pairs), rules.max_docs, rules.seed)
    pairs.write.mode("overwrite").parquet(_state(root, batch_id))


def corpus_stream(
    rows: DataFrame, root: str, progress: str, source: str = "corpus", rules: IngestRules = IngestRules()
) -> StreamingQuery:
    """Samples a stream of corpus rows (id, question, response, system_prompt) with all that is available, and waits.

    ``root`` and ``progress`` may be those of a stopped run.
    """
    query = (
        rows.writeStream.foreachBatch(lambda batch, batch_id: write_sample(batch, batch_id, root, source, rules))
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def latest_sample(spark: SparkSession, root: str, query: StreamingQuery) -> DataFrame:
    """The sample after the last batch of a finished query."""
    done = [p["batchId"] for p in query.recentProgress]
    return spark.read.parquet(_state(root, max(done)))
