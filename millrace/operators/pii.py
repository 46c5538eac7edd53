"""Redaction of structured personal data and its accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.barrier import computed_once


def label_name(label: str, style: str) -> str:
    return label if style == "bracket" else fixed.PII_ENTITY_NAMES[label]


def placeholder(label: str, style: str) -> str:
    return f"[{label}]" if style == "bracket" else f"<{fixed.PII_ENTITY_NAMES[label]}>"


def redact(df: DataFrame, fields: Sequence[str], style: str = "bracket", enabled: bool = True) -> DataFrame:
    """Replace personal data in ``fields`` and add ``<field>_found``, the labels that matched.

    Each pattern runs on the text the previous ones left. A replacement never
    equals what it replaces, so a changed text is a match and one pass per
    pattern is enough.
    """
    if style not in ("bracket", "entity"):
        raise ValueError(f"unknown placeholder style: {style}")
    if not enabled:
        return df.withColumns({f"{f}_found": F.array().cast("array<string>") for f in fields})

    current = {f: F.col(f) for f in fields}
    steps: list[str] = []
    for i, (label, pattern) in enumerate(fixed.PII_PATTERNS):
        replaced = {}
        for f in fields:
            name = f"_{f}_{i}"
            plain = F.regexp_replace(current[f], "(?U)" + pattern, placeholder(label, style).replace("$", "\\$"))
            if label == "EMAIL":
                plain = F.when(F.contains(current[f], F.lit("@")), plain).otherwise(current[f])
            if label == "PHONE":  # its optional beginnings are tried at every place, so the part that every match has goes first
                plain = F.when(F.regexp_like(current[f], F.lit("(?U)" + fixed.PHONE_CORE)), plain).otherwise(current[f])
            replaced[name] = plain
        df = df.withColumns(replaced)
        steps += list(replaced)
        current = {f: F.col(f"_{f}_{i}") for f in fields}

    out = {}
    for f in fields:
        chain = [F.col(f)] + [F.col(f"_{f}_{i}") for i in range(len(fixed.PII_PATTERNS))]
        flags = [
            F.when(before != after, F.lit(label_name(label, style)))
            for (label, _), before, after in zip(fixed.PII_PATTERNS, chain, chain[1:])
        ]
        out[f"{f}_found"] = F.coalesce(F.array_compact(F.array(*flags)), F.array().cast("array<string>"))
    out.update({f: current[f] for f in fields})
    return computed_once(df, out).drop(*steps)


def any_found(fields: Sequence[str]) -> Column:
    found = F.lit(False)
    for f in fields:
        found = found | (F.size(f"{f}_found") > 0)
    return found


def entity_totals(redacted: DataFrame, fields: Sequence[str], style: str = "bracket") -> DataFrame:
    """Rows with any hit and hits per label, where each field of a row counts once per label."""
    names = [label_name(label, style) for label, _ in fixed.PII_PATTERNS]
    sums = [F.count_if(any_found(fields)).alias("records")]
    for name in names:
        hits = F.lit(0)
        for f in fields:
            hits = hits + F.array_contains(f"{f}_found", name).cast("int")
        sums.append(F.coalesce(F.sum(hits), F.lit(0)).alias(name))
    total = redacted.agg(*sums)
    return total.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("entity"), F.col(n).cast("long").alias("n")) for n in ["records", *names]]
            )
        ).alias("e")
    ).select("e.entity", "e.n")
