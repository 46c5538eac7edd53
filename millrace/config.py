"""Job parameters. Every threshold is a field here; operators turn them into literals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QualityRules:
    min_question_words: int = 3
    max_question_words: int = 1200
    min_answer_words: int = 5
    max_answer_words: int = 800
    min_mean_word_len: float = 2.5
    max_mean_word_len: float = 12.0
    min_stopwords: int = 2
    max_top_ngram_ratio: float = 0.25
    max_caps_ratio: float = 0.40
    max_symbol_word_ratio: float = 0.20
    max_question_echo_ratio: float = 0.90
    reject_refusals: bool = True
    reject_truncated: bool = True
    blocklist_hits_allowed: int = 0


@dataclass(frozen=True)
class CurationRules:
    near_dup_threshold: float = 0.92
    pii_enabled: bool = True
    placeholder_style: str = "bracket"  # or "entity"


@dataclass(frozen=True)
class IngestRules:
    max_docs: int = 5000
    seed: int = 42
    keep_categories: tuple[str, ...] = ("flan", "t0", "niv", "cot")


@dataclass(frozen=True)
class SplitRules:
    val: float = 0.10
    test: float = 0.05
    seed: int = 42


@dataclass(frozen=True)
class GateRules:
    min_pass_rate: float = 0.80
    min_vs_baseline: float = 0.0
    min_category_pass_rate: float = 0.50


@dataclass(frozen=True)
class ServingLimits:
    max_message_chars: int = 4000
    max_prompt_chars: int = 4000
    max_history_turns: int = 10
    max_new_tokens: int = 512
    default_new_tokens: int = 256
    temperature: float = 0.7
    top_p: float = 0.9
    quota_per_minute: int = 60
    quota_enabled: bool = True
    cache_ttl_s: int = 3600
    cache_enabled: bool = True


@dataclass(frozen=True)
class AlertRules:
    """Thresholds and hold times (whole minutes)."""

    error_share: float = 0.05
    error_hold_min: int = 5
    p95_s: float = 3.0
    p95_hold_min: int = 10
    upstream_hold_min: int = 2
    canary_share: float = 0.10
    canary_hold_min: int = 5
    rate_window_min: int = 5


@dataclass(frozen=True)
class DriftPolicy:
    quality_drop: float = 0.05
    error_ceiling: float = 0.05
    latency_ceiling_s: float = 3.0
    min_new_examples: int = 50
    unknown_topic_ceiling: float = 0.30
