"""Group sizes attached to rows without gathering a large group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

LISTED_GROUPS = 20_000
SMALLEST_LARGE = 10_000


def with_shared_size(
    rows: DataFrame, keys: Sequence[str], label: str, out: str = "n", extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows of groups with at least two members, with the group's size and any ``extra`` aggregates.

    Sizes come from a combined count. Rows of the few very large groups find
    theirs in a broadcast table, which has at most ``LISTED_GROUPS`` rows because
    each listed group holds more than that fraction of all rows; all other rows
    join on a key that is then known to be small. ``rows`` is read several times
    and should be a written table or cheap.
    """
    keys = list(keys)
    more = [c.alias(name) for name, c in (extra or {}).items()]
    counts = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(out), *more).where(F.col(out) > 1), label)
    total = counts.agg(F.sum(out)).first()[0] or 0
    if total <= SMALLEST_LARGE:
        return rows.join(counts, keys)
    large = max(SMALLEST_LARGE, total // LISTED_GROUPS)
    listed = F.broadcast(counts.where(F.col(out) > large).withColumnRenamed(out, "_big"))
    tagged = rows.join(listed, keys, "left")
    known = tagged.where(F.col("_big").isNotNull()).withColumnRenamed("_big", out)
    rest = tagged.where(F.col("_big").isNull()).drop("_big", *(extra or {})).join(counts.where(F.col(out) <= large), keys)
    return known.unionByName(rest)
