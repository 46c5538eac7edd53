"""Golden-set judging, pass rates and the release gate, for any number of models at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import GateRules
from millrace.functions import fixed
from millrace.functions.rounding import nearest_places

FLAGS = "(?iuU)"


class GateBlocked(ValueError):
    """Raised when the gate does not approve a model."""


class Misaligned(ValueError):
    """Raised when answers and golden cases do not match one to one."""


def percent(share: Column) -> Column:
    """A share as whole percent, half-even."""
    return F.concat(F.bround(share * 100, 0).cast("int").cast("string"), F.lit("%"))


def judge(answers: DataFrame, golden: DataFrame) -> DataFrame:
    """Judge (model, case_id, answer) against golden cases.

    Passes iff some required pattern is found, or none is required, and no
    banned one is. The golden set is joined without a hint: the planner
    broadcasts it when its size allows and shuffles on ``case_id`` otherwise.
    """
    empty = F.array().cast("array<string>")
    must = F.coalesce("must_contain", empty)
    banned = F.coalesce("must_not_contain", empty)

    def found(p: Column) -> Column:
        return F.regexp_like(F.col("answer"), F.concat(F.lit(FLAGS), p))

    return (
        answers.join(golden, "case_id")
        .withColumn("forbidden_hits", F.filter(banned, found))
        .withColumn("passed", ((F.size(must) == 0) | F.exists(must, found)) & (F.size("forbidden_hits") == 0))
        .select(
            "model", "case_id", "question", "answer",
            F.coalesce("category", F.lit("uncategorized")).alias("category"),
            "passed", "forbidden_hits", must.alias("expected_any"),
        )
    )


def require_aligned(answers: DataFrame, golden: DataFrame) -> None:
    """Raise unless every model answers every golden case exactly once."""
    n = golden.count()
    per_model = (
        answers.join(golden.select("case_id", F.lit(1).alias("_known")), "case_id", "left")
        .groupBy("model")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("_known").alias("known"), F.countDistinct("case_id").alias("cases"))
        .where((F.col("rows") != n) | (F.col("known") != n) | (F.col("cases") != n))
    )
    bad = per_model.limit(5).collect()
    if bad:
        raise Misaligned(f"answers must align 1:1 with {n} golden cases: {[r['model'] for r in bad]}")


def rates(judged: DataFrame) -> DataFrame:
    """(model, category, total, passed, pass_rate); category is null on the overall row."""
    cells = judged.groupBy("model", "category").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed")
    )
    return (
        cells.groupingSets([[F.col("model")], [F.col("model"), F.col("category")]], F.col("model"), F.col("category"))
        .agg(F.sum("total").alias("total"), F.sum("passed").alias("passed"), F.grouping("category").alias("overall"))
        .withColumn("overall", F.col("overall") == 1)
        .withColumn("pass_rate", nearest_places(F.col("passed") / F.greatest("total", F.lit(1)), 4))
    )


def decide(
    rated: DataFrame, rules: GateRules = GateRules(), baseline: DataFrame | None = None
) -> DataFrame:
    """One decision per model: (model, pass_rate, baseline_rate, approved, reasons).

    ``baseline`` has (model, baseline_rate): the rate of the model it must not
    fall below. Reasons come in fixed order: floor, regression, then categories by name.
    """
    overall = rated.where("overall").select("model", "pass_rate")
    low = (
        rated.where(~F.col("overall") & (F.col("pass_rate") < rules.min_category_pass_rate))
        .groupBy("model")
        .agg(F.sort_array(F.collect_list(F.struct("category", "pass_rate"))).alias("_low"))
    )
    joined = overall.join(low, "model", "left")
    if baseline is None:
        joined = joined.withColumn("baseline_rate", F.lit(None).cast("double"))
    else:
        joined = joined.join(baseline.select("model", "baseline_rate"), "model", "left")

    rate, base = F.col("pass_rate"), F.col("baseline_rate")
    below_floor = F.when(
        rate < rules.min_pass_rate,
        F.format_string(fixed.GATE_FLOOR, percent(rate), percent(F.lit(rules.min_pass_rate))),
    )
    regressed = F.when(
        rate < base + rules.min_vs_baseline,
        F.format_string(fixed.GATE_REGRESSION, percent(rate), percent(base)),
    )
    weak = F.transform(
        F.coalesce("_low", F.array().cast("array<struct<category:string,pass_rate:double>>")),
        lambda c: F.format_string(
            fixed.GATE_CATEGORY, c["category"], percent(c["pass_rate"]), percent(F.lit(rules.min_category_pass_rate))
        ),
    )
    return (
        joined.withColumn("_r", F.concat(F.array_compact(F.array(below_floor, regressed)), weak))
        .withColumn("approved", F.size("_r") == 0)
        .withColumn("reasons", F.when(F.col("approved"), F.array(F.lit(fixed.GATE_APPROVED))).otherwise(F.col("_r")))
        .select("model", "pass_rate", "baseline_rate", "approved", "reasons")
    )


def require_approved(decisions: DataFrame) -> None:
    blocked = decisions.where(~F.col("approved")).limit(20).collect()
    if blocked:
        raise GateBlocked("; ".join(f"{r['model']}: {', '.join(r['reasons'])}" for r in blocked))


def failures(judged: DataFrame) -> DataFrame:
    """Failed cases with what was hit, or else what was expected."""
    hit = F.size("forbidden_hits") > 0
    return judged.where(~F.col("passed")).select(
        "model", "case_id", "question",
        F.when(hit, F.lit("forbidden")).otherwise(F.lit("missing")).alias("why"),
        F.when(hit, F.col("forbidden_hits")).otherwise(F.col("expected_any")).alias("patterns"),
    )


def flag_low(rated: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    return rated.where(~F.col("overall")).withColumn("low", F.col("pass_rate") < rules.min_category_pass_rate)


def sweep(rated: DataFrame, floors: list[float], rules: GateRules = GateRules()) -> DataFrame:
    """The same results decided at several overall floors: (model, floor, pass_rate, blocked)."""
    per_model = rated.groupBy("model").agg(
        F.max(F.when(F.col("overall"), F.col("pass_rate"))).alias("pass_rate"),
        F.count_if(~F.col("overall") & (F.col("pass_rate") < rules.min_category_pass_rate)).alias("_low"),
    )
    return per_model.select(
        "model", "pass_rate", "_low", F.explode(F.array(*[F.lit(float(f)) for f in floors])).alias("floor")
    ).select(
        "model", "floor", "pass_rate", ((F.col("pass_rate") < F.col("floor")) | (F.col("_low") > 0)).alias("blocked")
    )


def lint_golden(golden: DataFrame, at_least: int = 20) -> DataFrame:
    """One row: cases, cases without a required pattern, without a ban list, and whether the set is sound.

    Every pattern is also compiled by the engine that will run it, so a pattern
    it cannot read fails here and not in the middle of an evaluation.
    """
    empty = F.array().cast("array<string>")
    every = F.concat(F.coalesce("must_contain", empty), F.coalesce("must_not_contain", empty))
    compiled = F.size(F.filter(every, lambda p: F.regexp_like(F.lit(""), F.concat(F.lit(FLAGS), p)).isNotNull()))
    no_must = F.count_if(F.coalesce(F.size("must_contain"), F.lit(0)) < 1)
    no_ban = F.count_if(F.col("must_not_contain").isNull())
    return golden.agg(
        F.count(F.lit(1)).alias("cases"),
        no_must.alias("without_required"),
        no_ban.alias("without_ban_list"),
        F.coalesce(F.sum(compiled), F.lit(0)).alias("patterns"),
    ).withColumn(
        "sound", (F.col("cases") >= at_least) & (F.col("without_required") == 0) & (F.col("without_ban_list") == 0)
    )
