"""Evaluation job: judge, rate, decide, for candidates and an optional baseline model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import GateRules
from millrace.operators import evaluation
from millrace.session import materialize


@dataclass
class Evaluation:
    judged: DataFrame
    rates: DataFrame
    decisions: DataFrame


def evaluate(
    answers: DataFrame, golden: DataFrame, baseline_model: str | None = None, rules: GateRules = GateRules(), aligned: bool = True
) -> Evaluation:
    """Evaluate (model, case_id, answer). With ``baseline_model`` every other model is also held against it."""
    if aligned:
        evaluation.require_aligned(answers, golden)
    judged = materialize(evaluation.judge(answers, golden), "judged")
    rated = materialize(evaluation.rates(judged), "rates")
    baseline = None
    if baseline_model is not None:
        base = rated.where(F.col("overall") & (F.col("model") == baseline_model)).first()
        if base is None:
            raise ValueError(f"no answers of baseline model {baseline_model}")
        baseline = rated.where(F.col("overall") & (F.col("model") != baseline_model)).select(
            "model", F.lit(base["pass_rate"]).alias("baseline_rate")
        )
    return Evaluation(judged, rated, evaluation.decide(rated, rules, baseline))


def report_document(result: Evaluation) -> DataFrame:
    """One nested row per model for the JSON sink: totals, per-category map, decision."""
    overall = result.rates.where("overall").select("model", "total", "passed", "pass_rate")
    cells = F.struct("passed", "total", "pass_rate")
    per_category = (
        result.rates.where(~F.col("overall"))
        .groupBy("model")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("category"), cells)))).alias("per_category"))
    )
    decision = result.decisions.select("model", F.struct("approved", "reasons").alias("decision"))
    return overall.join(per_category, "model", "left").join(decision, "model")
