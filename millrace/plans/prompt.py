"""Prompt job: nearest chunks of each conversation's question, context block, last turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import ServingLimits
from millrace.operators import requests, retrieval


def prompts(
    turns: DataFrame, questions: DataFrame, chunks: DataFrame, system_prompt: str, k: int = 3, limits: ServingLimits = ServingLimits()
) -> DataFrame:
    """(conv_id, messages) with retrieved context.

    ``questions`` has the vector of each conversation's question (id = conv_id, embedding),
    ``chunks`` the knowledge base (id, embedding, text).
    """
    hits = retrieval.nearest(questions, chunks, k)
    contexts = retrieval.context_blocks(hits, chunks).withColumnRenamed("query_id", "conv_id")
    return requests.assemble_from_turns(turns, system_prompt, limits=limits, contexts=contexts)


def unknown_rate(questions: DataFrame, chunks: DataFrame, min_score: float | None = None) -> DataFrame:
    """How many questions find no chunk of at least ``min_score``."""
    hits = retrieval.nearest(questions, chunks, 1)
    return retrieval.unknown_topic_rate(retrieval.context_found(questions.select(F.col("id")), hits, min_score))
