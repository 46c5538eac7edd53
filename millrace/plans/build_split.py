"""Dataset job: chat examples, honesty rows, validation, stratified split, leakage check, statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import SplitRules
from millrace.operators import chat, split, validate
from millrace.session import materialize


@dataclass
class Dataset:
    examples: DataFrame
    stats: DataFrame


def build_split(
    kept: DataFrame, system_prompt: str, honesty_pairs: DataFrame | None = None, rules: SplitRules = SplitRules()
) -> Dataset:
    """Turn curated pairs into a checked, split dataset; raises if a check fails.

    Validation comes before the split here, not only by run order. The examples are written
    once with a number, ``row``, which makes split and shuffle exact where ids are blank
    or repeat; both guards, the statistics and the sink read them with their split.
    """
    examples = chat.to_chat(kept, system_prompt)
    if honesty_pairs is not None:
        examples = chat.add_honesty(examples, honesty_pairs, system_prompt)
    examples = materialize(examples.withColumn("row", F.monotonically_increasing_id()), "examples")
    checked = validate.example_errors(examples).withColumn("line_no", F.col("row"))
    validate.require_valid(checked)
    done = split.assign(examples, "id", rules, tie="row")
    split.require_sound(done)
    return Dataset(done, split.stats(done))
