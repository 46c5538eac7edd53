"""Quality gate: the first failing rule names the reason, ``ok`` if none fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import QualityRules
from millrace.functions import fixed, text
from millrace.functions.barrier import computed_once

NGRAM = 3


def _echo_tokens(words: Column) -> Column:
    """Token set; a token made only of punctuation strips to the empty string and counts."""
    return F.array_distinct(F.transform(words, lambda w: text.trimmed_lower(w, fixed.ECHO_STRIP)))


def echo_ratio(question_words: Column, answer_words: Column) -> Column:
    """Share of the answer's token set that also occurs in the question's."""
    q, a = _echo_tokens(question_words), _echo_tokens(answer_words)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, q)) / F.size(a))


def is_echo(question_words: Column, answer_words: Column, max_ratio: float) -> Column:
    """Whether ``echo_ratio`` is above ``max_ratio``.

    The common tokens are at most the question's words. So if the answer's first words, twice as many as the question
    would need and 16, already hold enough different tokens, the ratio can't be above, and the rest of the answer needn't be looked at.
    """
    n_q = F.size(question_words)
    begin = F.slice(answer_words, F.lit(1), (F.ceil(n_q / max(max_ratio, 0.05)) * 2 + 16).cast("int"))
    below = n_q / F.size(_echo_tokens(begin)) <= max_ratio
    return F.when(F.size(answer_words) > 0, ~below).otherwise(True) & (echo_ratio(question_words, answer_words) > max_ratio)


def is_repetitive(answer_words: Column, max_ratio: float) -> Column:
    """Whether the commonest word 3-gram covers more than ``max_ratio`` of the words.

    "Some 3-gram occurs at least r times" holds iff, in sorted order, some entry
    equals the one r-1 places later, so no counting is needed.
    """
    n = F.size(answer_words)
    low = F.floor(F.lit(max_ratio) * n / NGRAM)
    needed = (
        F.when(low * NGRAM / n > max_ratio, low)
        .when((low + 1) * NGRAM / n > max_ratio, low + 1)
        .otherwise(low + 2)
        .cast("int")
    )
    grams = F.sort_array(
        F.slice(
            F.transform(
                answer_words,
                lambda w, i: F.xxhash64(w, F.get(answer_words, i + 1), F.get(answer_words, i + 2)),
            ),
            F.lit(1),
            F.greatest(n - (NGRAM - 1), F.lit(0)),
        )
    )
    runs = F.greatest(n - (NGRAM - 1) - needed + 1, F.lit(0))
    repeated = F.exists(
        F.zip_with(F.slice(grams, F.lit(1), runs), F.slice(grams, needed, runs), lambda x, y: x == y),
        lambda same: same,
    )
    return F.when(n < NGRAM * 3, F.lit(0.0) > max_ratio).otherwise(repeated)


def caps_ratio(answer_words: Column) -> Column:
    shouted = F.filter(
        answer_words,
        lambda w: (F.length(w) > 2) & (F.upper(w) == w) & (F.lower(w) != w),
    )
    return F.size(shouted) / F.size(answer_words)


def symbol_ratio(answer: Column, answer_words: Column) -> Column:
    def count(symbol: str) -> Column:
        gone = F.length(F.replace(answer, F.lit(symbol), F.lit("")))
        return (F.length(answer) - gone) / len(symbol)

    return (count("#") + count("...") + count("…")) / F.size(answer_words)


def mean_word_length(answer_words: Column) -> Column:
    return F.length(F.array_join(answer_words, "")) / F.size(answer_words)


def stopword_hits(answer_words: Column) -> Column:
    return F.size(
        F.filter(
            answer_words,
            lambda w: text.trimmed_lower(w, fixed.LANGUAGE_STRIP).isin(*fixed.STOPWORDS),
        )
    )


def has_few_stopwords(answer_words: Column, least: int) -> Column:
    """Whether ``stopword_hits`` is below ``least``; all words are looked at only if the first 64 don't have enough."""
    begin = F.slice(answer_words, F.lit(1), F.lit(64))
    return (stopword_hits(begin) < least) & (stopword_hits(answer_words) < least)


def is_truncated(answer_words: Column) -> Column:
    """The answer, without trailing space, ends in neither final punctuation, a digit nor a code fence."""
    last_word = F.element_at(answer_words, -1)
    last_char = F.substring(last_word, -1, 1)
    finished = (
        last_char.isin(*fixed.FINAL_CHARS)
        | F.regexp_like(last_char, F.lit(r"(?U)\d"))
        | F.endswith(last_word, F.lit(fixed.CODE_FENCE))
    )
    return ~finished


def is_refusal(lowered: Column) -> Column:
    """Whether a lower-cased answer has a phrase of refusal."""
    hit = F.lit(False)
    for phrase in fixed.REFUSAL_PHRASES:
        hit = hit | F.contains(lowered, F.lit(phrase))
    return hit


def blocked_terms(question: Column, answer: Column) -> Column:
    """How many different blocked substrings occur in question and answer together."""
    combined = F.lower(F.concat(question, F.lit(" "), answer))
    hits = F.lit(0)
    for term in fixed.BLOCKED_TERMS:
        hits = hits + F.contains(combined, F.lit(term)).cast("int")
    return hits


def gate(pairs: DataFrame, rules: QualityRules = QualityRules(), language: str | None = None) -> DataFrame:
    """Add ``reason`` to question/answer pairs.

    ``language`` may name a column with a language code from an outside detector;
    then a pair is English iff the code is ``en``. Otherwise the function-word
    rule decides. Word arrays and the lower-cased answer are built once per row; the branches of the CASE
    are evaluated in order, so costly rules only see rows that passed the cheap ones.
    """
    q, a = F.col("question"), F.col("answer")
    qw, aw = F.col("_qw"), F.col("_aw")
    n_q, n_a = F.size(qw), F.size(aw)
    not_english = F.col(language) != "en" if language else has_few_stopwords(aw, rules.min_stopwords)
    if language:
        not_english = F.coalesce(not_english, F.lit(True))

    steps: list[tuple[str, Column]] = [
        ("empty_question", F.coalesce(n_q, F.lit(0)) <= 0),
        ("empty_answer", F.coalesce(n_a, F.lit(0)) <= 0),
        ("question_length", ~n_q.between(rules.min_question_words, rules.max_question_words)),
        ("answer_length", ~n_a.between(rules.min_answer_words, rules.max_answer_words)),
    ]
    if rules.reject_refusals:
        steps.append(("refusal", is_refusal(F.col("_low"))))
    steps += [
        ("question_echo", is_echo(qw, aw, rules.max_question_echo_ratio)),
        ("repetition", is_repetitive(aw, rules.max_top_ngram_ratio)),
        ("all_caps", caps_ratio(aw) > rules.max_caps_ratio),
        ("symbol_ratio", symbol_ratio(a, aw) > rules.max_symbol_word_ratio),
        ("mean_word_length", ~mean_word_length(aw).between(rules.min_mean_word_len, rules.max_mean_word_len)),
        ("not_english", not_english),
    ]
    if rules.reject_truncated:
        steps.append(("truncated", is_truncated(aw)))
    steps.append(("blocklist", blocked_terms(q, a) > rules.blocklist_hits_allowed))

    reason = F.when(steps[0][1], F.lit(steps[0][0]))
    for name, failed in steps[1:]:
        reason = reason.when(failed, F.lit(name))
    worded = pairs.withColumns({"_qw": text.words(q), "_aw": text.words(a), "_low": F.lower(a)})
    return computed_once(worded, {"reason": reason.otherwise(F.lit("ok"))}).drop("_qw", "_aw", "_low")


def accepted(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("reason") == "ok")
