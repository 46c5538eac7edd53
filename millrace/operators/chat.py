"""Chat examples: build, extend, render."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import seeded_order

MESSAGE = "struct<role:string,content:string>"
CHAT_SCHEMA = f"messages array<{MESSAGE}>, category string"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_chat(pairs: DataFrame, system_prompt: str, row_id: str = "id") -> DataFrame:
    """(id, messages, category): one fixed system prompt, the question, the answer."""
    messages = F.array(
        message("system", F.lit(system_prompt.strip())),
        message("user", F.col("question")),
        message("assistant", F.col("answer")),
    )
    return pairs.select(F.col(row_id).cast("string").alias("id"), messages.alias("messages"), "category")


def add_honesty(examples: DataFrame, honesty_pairs: DataFrame, system_prompt: str) -> DataFrame:
    """Append caller-supplied honesty pairs (id, question, answer), after and outside dedup."""
    extra = honesty_pairs.withColumn("category", F.lit("honesty"))
    return examples.unionByName(to_chat(extra, system_prompt))


def shuffled(examples: DataFrame, seed: int, row_id: str = "id") -> DataFrame:
    """A seeded total order for the sink; range-partitioned, not gathered. A column ``row`` orders equal ids."""
    if "row" in examples.columns:
        named = F.concat_ws("|", F.col(row_id).cast("string"), F.col("row").cast("string"))
        return examples.orderBy(seeded_order(seed, named), "row")
    return examples.orderBy(seeded_order(seed, F.col(row_id)), row_id)


def user_message(messages: Column) -> Column:
    """Content of the first user message."""
    return F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"]


def last_content(messages: Column) -> Column:
    return F.element_at(messages, -1)["content"]


def render(examples: DataFrame, prefixes: Mapping[str, str], suffix: str) -> DataFrame:
    """Add ``text``: all messages in one string, with the caller's role markers."""
    marker = F.create_map(*[F.lit(x) for item in prefixes.items() for x in item])
    rendered = F.transform(
        "messages", lambda m: F.concat(F.element_at(marker, m["role"]), m["content"], F.lit(suffix))
    )
    return examples.withColumn("text", F.array_join(rendered, ""))
