"""Views of the benchmark tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_QUESTION = "what is this text about"
PROMPT_ANSWER = "This is a short answer to the question that was asked, and it is the same for all of them."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turn_key() -> Column:
    """A number that orders all turns; unique while turns and conversations are below 2**31 and 2**32."""
    return F.col("conv_id") * (1 << 31) + F.col("turn")


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it.

    The next turn is found by an equi-join on (conversation, turn + 1), a unique
    key, so a very long conversation is not gathered in one task.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    replied = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(replied, ["conv_id", "turn"]).select(
        turn_key().alias("pos"),
        F.concat(F.lit("conv."), F.col("conv_id").cast("string"), F.lit("."), F.col("turn").cast("string")).alias("id"),
        "question",
        "answer",
        F.lit("").alias("orig_system_prompt"),
        F.when(F.col("turn") < 2, F.lit("opening")).otherwise(F.lit("follow_up")).alias("category"),
        F.lit("conversations").alias("source"),
    )


def document_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the answer to one fixed question; category is its language."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.col("doc_id").cast("string").alias("id"),
        F.lit(DOCUMENT_QUESTION).alias("question"),
        F.col("text").alias("answer"),
        F.lit("").alias("orig_system_prompt"),
        F.col("lang").alias("category"),
        "source",
    )


def document_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a prompt with one fixed reply; category is its language."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("question"),
        F.lit(PROMPT_ANSWER).alias("answer"),
        F.lit("").alias("orig_system_prompt"),
        F.col("lang").alias("category"),
        "source",
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a request log.

    Client, time, prompt number, latency and status come from the event's
    columns; the prompt number also stands for the token count.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("client"),
        F.lit("/v1/chat").alias("route"),
        "event_type",
        "value",
        k.alias("k"),
        (F.col("value") / 100).alias("latency_s"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
    )
