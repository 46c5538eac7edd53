"""Columns that later filters read instead of recomputing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` for costly expressions.

    The optimizer pushes a filter on a projected column below the projection by
    copying the expression into it, and a chain of regular expressions is then
    copied many times over. A one-row generator gives the same columns but is not
    looked through, so each expression runs once per row.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(packed))
