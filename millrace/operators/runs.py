"""Training-run tables: lineage, leaderboard, generations side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Logged column names and the short names they get on the board.
BOARD_COLUMNS = {
    "tags.mlflow.runName": "run",
    "params.lora_r": "r",
    "params.epochs": "epochs",
    "params.learning_rate": "lr",
    "params.data_version": "data",
    "params.git_sha": "sha",
    "metrics.eval_loss": "eval_loss",
}


def with_lineage(df: DataFrame, lineage: Mapping[str, object]) -> DataFrame:
    """Attach data version, code revision, seed and parameters as constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in lineage.items()})


def board(runs: DataFrame, columns: Mapping[str, str] = BOARD_COLUMNS, drop_missing: bool = False) -> DataFrame:
    """Known columns that exist, renamed and sorted by loss; a NaN loss counts as missing and goes last."""
    have = [c for c in columns if c in runs.columns]
    view = runs.select(*[F.col(f"`{c}`").alias(columns[c]) for c in have])
    if "eval_loss" not in view.columns:
        return view
    view = view.withColumn("eval_loss", F.when(~F.isnan("eval_loss"), F.col("eval_loss")))
    if drop_missing:
        view = view.where(F.col("eval_loss").isNotNull())
    return view.orderBy(F.col("eval_loss").asc_nulls_last())


def best(view: DataFrame) -> DataFrame:
    """The run with the lowest loss; no row if no run has one."""
    return view.where(F.col("eval_loss").isNotNull()).orderBy("eval_loss").limit(1)


def side_by_side(generations: DataFrame, runs: Sequence[str]) -> DataFrame:
    """One row per prompt with each run's response, from (run, prompt, response)."""
    return generations.groupBy("prompt").pivot("run", list(runs)).agg(F.min("response"))
