"""Stratified split, leakage check, dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import SplitRules
from millrace.functions.hashing import seeded_order
from millrace.functions.ranks import keys_at_ranks
from millrace.functions.rounding import nearest_places
from millrace.functions.text import leakage_text
from millrace.operators.chat import last_content, user_message
from millrace.session import materialize

SPLITS = ("train", "val", "test")


class SplitLeak(ValueError):
    """Raised when one question occurs in more than one split."""


class EmptySplit(ValueError):
    """Raised when a split has no rows."""


def with_sizes(counts: DataFrame, rules: SplitRules = SplitRules()) -> DataFrame:
    """Add ``n_train``, ``n_val``, ``n_test`` to category counts ``n``.

    Rounding is half-even. One row trains; of two, one validates; otherwise both
    small splits get at least one row and give way, validation first, until a
    training row is left.
    """
    n = F.col("n")
    val = F.greatest(F.lit(1), F.bround(n * rules.val, 0).cast("long"))
    test = F.greatest(F.lit(1), F.bround(n * rules.test, 0).cast("long"))
    lacking = F.greatest(F.lit(0), 1 - (n - F.col("_v") - F.col("_t")))
    sized = counts.withColumns({"_v": val, "_t": test}).withColumn("_lack", lacking)
    sized = sized.withColumn("_v2", F.greatest(F.lit(1), F.col("_v") - F.col("_lack")))
    sized = sized.withColumn(
        "_t2", F.greatest(F.lit(1), F.col("_t") - (F.col("_lack") - (F.col("_v") - F.col("_v2"))))
    )
    sized = sized.withColumns(
        {
            "n_val": F.when(n == 1, 0).when(n == 2, 1).otherwise(F.col("_v2")).cast("long"),
            "n_test": F.when(n <= 2, 0).otherwise(F.col("_t2")).cast("long"),
        }
    )
    return sized.withColumn("n_train", n - F.col("n_val") - F.col("n_test")).drop("_v", "_t", "_lack", "_v2", "_t2")


def sizes(df: DataFrame, rules: SplitRules = SplitRules()) -> DataFrame:
    return with_sizes(df.groupBy("category").agg(F.count(F.lit(1)).alias("n")), rules)


def assign(df: DataFrame, row_id: str, rules: SplitRules = SplitRules(), tie: str | None = None) -> DataFrame:
    """Add ``split``: exact sizes per category, membership by seeded hash order.

    Ids that are blank or repeat need ``tie``, a unique column, to keep the sizes exact.

    Instead of numbering every category's rows, the two boundary hashes are
    found exactly and each row compares its own hash with them, so the rows
    themselves neither shuffle nor sort and a category of any size is no hot spot.
    """
    named = F.col(row_id).cast("string")
    if tie is not None:
        named = F.concat_ws("|", named, F.col(tie).cast("string"))
    order = F.concat(seeded_order(rules.seed, named), F.lit("|"), named)
    keyed = df.withColumn("_k", order)
    wanted = sizes(df, rules).select(
        "category",
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("name"), F.col("n_train").alias("rank")),
                F.struct(F.lit("val").alias("name"), (F.col("n_train") + F.col("n_val")).alias("rank")),
            )
        ).alias("w"),
    ).select("category", "w.name", "w.rank")
    cuts = keys_at_ranks(keyed.select("category", "_k"), ["category"], "_k", wanted)
    cuts = cuts.groupBy("category").agg(
        F.max(F.when(F.col("name") == "train", F.col("cut"))).alias("_train"),
        F.max(F.when(F.col("name") == "val", F.col("cut"))).alias("_val"),
    )
    # One row per category, written first so that the planner knows its size.
    cuts = materialize(cuts, "split-cuts")
    label = (
        F.when(F.col("_train").isNull() | (F.col("_k") <= F.col("_train")), F.lit("train"))
        .when(F.col("_k") <= F.col("_val"), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    # A row without a category is kept, for training.
    return keyed.join(cuts, "category", "left").withColumn("split", label).drop("_k", "_train", "_val")


def leaks(keys: DataFrame) -> DataFrame:
    """Keys in more than one split, (key, leaks), from (key, split).

    Split names fold into a bit mask, which combines before the shuffle.
    """
    bit = F.when(F.col("split") == "train", 1).when(F.col("split") == "val", 2).otherwise(4)
    return (
        keys.groupBy("key").agg(F.bit_or(bit).alias("_mask"))
        .select("key", (F.bit_count("_mask") - 1).alias("leaks"))
        .where("leaks > 0")
    )


def leakage_keys(examples: DataFrame) -> DataFrame:
    return examples.select(leakage_text(user_message(F.col("messages"))).alias("key"), "split")


def leak_total(keys: DataFrame) -> DataFrame:
    found = leaks(keys)
    return found.agg(F.coalesce(F.sum("leaks"), F.lit(0)).alias("leaks"), F.count(F.lit(1)).alias("keys"))


def require_sound(examples: DataFrame) -> None:
    """Raise on a leak or an empty split; reads one row and three counts."""
    total = leak_total(leakage_keys(examples)).first()["leaks"]
    if total:
        raise SplitLeak(f"{total} questions appear in more than one split")
    present = {r["split"]: r["count"] for r in examples.groupBy("split").count().collect()}
    for name in SPLITS:
        if not present.get(name):
            raise EmptySplit(f"split {name!r} has no examples")


def stats(examples: DataFrame, chars: Column | None = None) -> DataFrame:
    """(level, name, n, avg_answer_chars) for all rows, each split and each category."""
    length = F.length(last_content(F.col("messages"))) if chars is None else chars
    cells = examples.select("split", "category", length.alias("_c")).groupBy("split", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_c").alias("_c")
    )
    levels = cells.groupingSets([[], [F.col("split")], [F.col("category")]], F.col("split"), F.col("category")).agg(
        F.sum("n").alias("n"),
        F.sum("_c").alias("_c"),
        F.grouping("split").alias("_gs"),
        F.grouping("category").alias("_gc"),
    )
    level = F.when(F.col("_gs") == 0, "split").when(F.col("_gc") == 0, "category").otherwise("all")
    return levels.select(
        level.alias("level"),
        F.coalesce("split", "category", F.lit("all")).alias("name"),
        "n",
        nearest_places(F.col("_c") / F.greatest("n", F.lit(1)), 1).alias("avg_answer_chars"),
    )
