"""Curation job: gate, redact, exact dedup, near dedup, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import CurationRules, QualityRules
from millrace.operators import dedup, pii, quality, report
from millrace.session import materialize

FIELDS = ("question", "answer")


@dataclass
class Curated:
    """``judged`` has every input row and its final reason; ``kept`` the redacted survivors."""

    judged: DataFrame
    kept: DataFrame
    redacted: DataFrame
    counts: DataFrame
    entities: DataFrame


def curate(
    pairs: DataFrame,
    quality_rules: QualityRules = QualityRules(),
    rules: CurationRules = CurationRules(),
    language: str | None = None,
) -> Curated:
    """Run the curation job over pairs with a unique, ordering ``pos``.

    Text is written once, gated and redacted in one pass; of rejected rows only their
    reason is. Both dedup steps read it where it lies and give one narrow table of
    dropped positions. Texts are read once more for the survivors.
    """
    gated = quality.gate(pairs, quality_rules, language)
    ok = F.col("reason") == "ok"
    texts = gated.withColumns({f: F.when(ok, F.col(f)) for f in FIELDS})
    wide = materialize(pii.redact(texts, FIELDS, rules.placeholder_style, rules.pii_enabled), "judged")
    redacted = wide.where(ok)
    dropped = materialize(dedup.drops(redacted, rules.near_dup_threshold), "dropped")
    kept = redacted.join(dropped, "pos", "left_anti").drop("reason", "question_found", "answer_found")
    judged = wide.select("pos", "category", "reason").join(dropped, "pos", "left").select(
        "pos", "category", F.coalesce("dropped", "reason").alias("reason")
    )
    counts = report.reason_counts(judged)
    entities = pii.entity_totals(redacted, FIELDS, rules.placeholder_style)
    return Curated(judged, kept, redacted, counts, entities)
