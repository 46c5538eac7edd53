"""Licence scans with ordered signature rules, in DataFrame functions only.

Most texts hold no keyword of any rule; their words are counted and that is all. The others
become lower-cased words with a space on both sides of each; each keyword is looked for once, and the rules of
those that occur run their regular expressions; every place found is an interval of words. Intervals are sorted and
folded once: one that lies inside an earlier interval of the same or a higher priority
is suppressed. A text of very many mentions takes time in n ** 1.5 of them (:func:`running`). All of it happens within the row, so nothing is shuffled and a lost task
repeats its own rows only.

Null and empty texts have no words and no detections. Repeated rows give repeated
results. Other columns are passed through untouched by :func:`detect`, which replaces
``words`` and ``detections``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.barrier import computed_once
from millrace.llm.common import lower_ascii
from millrace.llm.license_rules import RULES, Rule

#: Fixed value: what separates words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MARK = "\u0001"
#: Confidence of a detection by the rule's priority.
WEIGHTS = {1: 0.5, 2: 0.8, 3: 1.0}
RULE_TABLE = "array<struct<keyword:string,rules:array<struct<number:int,label:string,regex:string,priority:int,base:boolean>>>>"
DETECTION = "struct<start:int,end:int,label:string,priority:int,base:boolean,rule:int,kept:boolean>"


def spaced_words(text: Column) -> Column:
    """Every word with one space before and one after it; empty if there is no word."""
    words = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, "  "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def word_count(spaced: Column) -> Column:
    """Words of a spaced text: half its spaces."""
    return ((F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("int")


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often and wherever it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running(items: Column, state: Column, add: Callable[[Column, Column], Column], join: Callable[[Column, Column], Column],
            row: Callable[[Column, Column], Column], empty: str) -> Column:
    """``row(state before x, x)`` of every item, in order: a scan in two levels.

    A state grows by ``add(state, x)``, and ``join`` adds the states of two stretches. A list can only grow by
    being copied, so items go in blocks of about the square root of their number: first the state ahead of every
    block, then every block from its own state. ``n`` items take n ** 1.5 copies instead of n * n.
    """
    none = F.array().cast(f"array<{empty}>")

    def scan(xs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(xs))).cast("int")
        blocks = F.when(F.size(xs) > 0, F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width).cast("int")), lambda i: F.slice(xs, i * width + 1, width)
        )).otherwise(F.slice(F.array(xs), 1, 0))
        return bound(blocks, chained)

    def chained(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, state, add))
        ahead = F.aggregate(
            sums,
            F.struct(state.alias("at"), F.slice(F.array(state), 1, 0).alias("out")),
            lambda acc, s: F.struct(join(acc["at"], s).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        return F.flatten(F.zip_with(blocks, ahead, lambda block, at: F.aggregate(
            block,
            F.struct(at.alias("at"), none.alias("out")),
            lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(row(acc["at"], x))).alias("out")),
            lambda acc: acc["out"],
        )))

    return bound(items, scan)


def _places(spaced: Column, rule: Column) -> Column:
    """Where a rule matches: (start, end) in words, end exclusive."""
    regex = rule["regex"]
    found = F.transform(F.regexp_extract_all(spaced, regex, F.lit(0)), word_count)
    pieces = F.transform(F.split(F.regexp_replace(spaced, regex, F.lit(MARK + "$0")), MARK), word_count)
    # a piece before a match starts at the match before it, so starts are sums of pieces
    starts = running(pieces, F.lit(0), lambda at, n: at + n, lambda at, n: at + n, lambda at, n: at + n, "int")
    return bound(found, lambda lengths: F.zip_with(
        F.slice(starts, F.lit(1), F.size(lengths)),
        lengths,
        # the order of the fields is the order of the fold: from the left, longer first, stronger first
        lambda start, n: F.struct(
            start.alias("start"), (-(start + n)).alias("reach"), (-rule["priority"]).alias("rank"), rule["number"].alias("rule"),
            rule["label"].alias("label"), rule["base"].alias("base"),
        ),
    ))


def _fold(places: Column) -> Column:
    """Detections in order, each with whether it is kept."""
    levels = sorted(WEIGHTS)
    # e1 is the farthest end of any detection so far, e2 of those of priority 2 or more, ...
    ends = F.struct(*[F.lit(-1).alias(f"e{p}") for p in levels])

    def farther(ahead: Column, x: Column) -> Column:
        end, priority = -x["reach"], -x["rank"]
        return F.struct(*[F.when(priority >= p, F.greatest(ahead[f"e{p}"], end)).otherwise(ahead[f"e{p}"]).alias(f"e{p}") for p in levels])

    def both(one: Column, other: Column) -> Column:
        return F.struct(*[F.greatest(one[f"e{p}"], other[f"e{p}"]).alias(f"e{p}") for p in levels])

    def detection(ahead: Column, x: Column) -> Column:
        end, priority = -x["reach"], -x["rank"]
        far = F.lit(-1)
        for p in levels:
            far = F.when(priority == p, ahead[f"e{p}"]).otherwise(far)
        return F.struct(
            x["start"].alias("start"), end.alias("end"), x["label"].alias("label"), priority.alias("priority"),
            x["base"].alias("base"), x["rule"].alias("rule"), (far < end).alias("kept"),
        )

    return running(F.array_sort(places), ends, farther, both, detection, DETECTION)


def rule_table(rules: Sequence[Rule]) -> Column:
    """The rules by keyword, as one constant: an array of (keyword, rules)."""
    by_keyword: dict[str, list[dict]] = {}
    for r in rules:
        by_keyword.setdefault(r.keyword, []).append({f: getattr(r, f) for f in ("number", "label", "regex", "priority", "base")})
    table = json.dumps([{"keyword": k, "rules": group} for k, group in by_keyword.items()])
    return F.from_json(F.lit(table), RULE_TABLE)


def detect(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES), text: str = "text") -> DataFrame:
    """``docs`` with ``words`` (their number) and ``detections``: intervals of words with label, priority, rule, kept."""
    docs = docs.drop("words", "detections")
    whole = F.coalesce(F.col(text), F.lit(""))
    # working columns get names that the caller's columns don't have
    used = {c.lower() for c in docs.columns}
    lower, gated, space = (name + "_" * max((len(c) for c in used), default=0) for name in ("_lower", "_gate", "_spaced"))
    lowered = computed_once(docs, {lower: F.lower(whole)})  # lowers more than A-Z, which the gate may
    gate = F.lit(False)
    for piece in sorted({r.gate for r in rules}):
        gate = gate | F.contains(F.col(lower), F.lit(piece))
    with_words = computed_once(
        lowered.withColumn(gated, gate).drop(lower), {space: F.when(F.col(gated), spaced_words(whole)).otherwise(F.lit(""))}
    )
    spaced = F.col(space)
    groups = F.filter(rule_table(rules), lambda g: F.contains(spaced, g["keyword"]))
    active = F.flatten(F.transform(groups, lambda g: F.filter(g["rules"], lambda r: F.regexp_like(spaced, r["regex"]))))
    found = _fold(F.flatten(F.transform(active, lambda r: _places(spaced, r))))
    none = F.array().cast(f"array<{DETECTION}>")
    made = computed_once(
        with_words,
        {"words": F.regexp_count(whole, F.lit(WORD)).cast("long"), "detections": F.when(spaced != "", found).otherwise(none)},
    )
    return made.drop(space, gated)


def summary(detected: DataFrame) -> DataFrame:
    """Per document: base places, base labels, all labels that stand, and a score."""
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: d["kept"])
    starts = F.transform(base, lambda d: d["start"].cast("long"))

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    weight = F.create_map(*[F.lit(x) for p, w in WEIGHTS.items() for x in (p, w)])
    score = F.array_max(F.transform(kept, lambda d: weight[d["priority"]]))
    return detected.select(
        F.col("doc_id"),
        F.col("words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.filter("detections", lambda d: d["base"] | d["kept"])).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
        F.size(kept).cast("long").alias("n_kept"),
    )


def oracle() -> str:
    """The same in SQL: every rule against every text with its keyword, suppression by a self-join."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(
        f"({r.number}, {quote(r.label)}, {quote(r.keyword)}, {quote(r.regex)}, {r.priority}, {str(r.base).lower()})" for r in RULES
    )
    weights = " ".join(f"WHEN {p} THEN {w}" for p, w in WEIGHTS.items())
    return f"""
WITH rules(number, label, keyword, regex, priority, base) AS (VALUES {values}),
words AS (
  SELECT row_number() OVER () AS k, doc_id, CASE WHEN w = '' THEN '' ELSE ' ' || w || ' ' END AS spaced FROM (
    SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g'), ' ') AS w FROM documents)),
marked AS (
  SELECT k, number, label, priority, base, regexp_extract_all(spaced, regex) AS found,
         string_split(regexp_replace(spaced, regex, chr(1) || '\\0', 'g'), chr(1)) AS parts
  FROM words JOIN rules ON contains(spaced, keyword) AND regexp_matches(spaced, regex)),
placed AS (
  SELECT k, number, label, priority, base, i,
    CAST(list_sum(list_transform(parts[1:i], lambda p: (length(p) - length(replace(p, ' ', ''))) // 2)) AS BIGINT) AS s,
    (length(found[i]) - length(replace(found[i], ' ', ''))) // 2 AS n
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM marked)),
d AS (SELECT *, s + n AS e FROM placed),
judged AS (
  SELECT d.*, NOT EXISTS (SELECT 1 FROM d o WHERE o.k = d.k AND o.s <= d.s AND o.e >= d.e AND o.priority >= d.priority
    AND (o.number, o.s) <> (d.number, d.s)
    AND ((o.s, -o.e, -o.priority, o.number) < (d.s, -d.e, -d.priority, d.number))) AS kept FROM d)
SELECT doc_id, CAST((length(spaced) - length(replace(spaced, ' ', ''))) // 2 AS BIGINT) AS n_words,
  count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept), '') AS labels,
  coalesce(max(CASE priority {weights} END) FILTER (kept), 0.0) AS score,
  count(number) AS n_detections, count(*) FILTER (kept) AS n_kept
FROM words LEFT JOIN judged USING (k) GROUP BY k, doc_id, spaced
"""
