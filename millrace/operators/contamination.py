"""Evaluation items found in training rows: by normalised question, or by shared word runs in long texts.

The key form marks rows whose leakage key is a key of the golden set. The text form asks how much of an
item stands in a document: the share of the item's distinct word runs that the document holds. It is not
symmetric, so a short item inside a long document counts in full. The items are turned into an index from
word run to item; documents meet it run by run and what they share is counted, nothing is compared pairwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import dedup_text, tokens
from millrace.session import materialize

RUN_WORDS = 5
MIN_SHARE = 0.8
#: Golden keys up to this many become a list in the filter, which a scan of stored keys can use.
LISTED_KEYS = 1_000
#: An index of up to so many (run, item) rows is broadcast, about 64 MiB.
BROADCAST_RUNS = 1_500_000
#: Parts a run's documents are dealt into when the index is shuffled.
SALTS = 16


def runs_of(toks: Column, n: int) -> Column:
    """(h, first): hash and first word of every run of ``n`` words, repeats included; none if there are fewer words."""
    each = F.transform(
        toks, lambda w, i: F.struct(F.xxhash64(F.lit(n), *[F.get(toks, i + k) for k in range(n)]).alias("h"), i.cast("int").alias("first"))
    )
    return F.slice(each, 1, F.greatest(F.size(toks) - (n - 1), F.lit(0)))


def item_index(items: DataFrame, n: int = RUN_WORDS, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words, h, size): the distinct runs of every item, of ``words`` words each, and how many it has.

    An item of fewer than ``n`` words is one run of all of them; a blank or null one has none and is never found.
    Rows that repeat an item's id count as one item, with the runs of all of them.
    """
    toks = tokens(dedup_text(F.col(text)))
    rows = items.select(F.col(item_id).alias("item"), toks.alias("t")).where(F.size("t") > 0)
    words = F.least(F.size("t"), F.lit(n))
    picked = F.lit(None)
    for k in range(1, n + 1):
        picked = F.when(words == k, runs_of(F.col("t"), k)).otherwise(picked)
    each = rows.select("item", words.alias("words"), F.explode(picked).alias("r")).select("item", "words", "r.h").distinct()
    sizes = each.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    return each.join(sizes.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item"))).drop("_item")


def contamination_spans(
    docs: DataFrame, items: DataFrame, share: float = MIN_SHARE, n: int = RUN_WORDS, doc_id: str = "doc_id", item_id: str = "item_id",
    text: str = "text", broadcast_runs: int = BROADCAST_RUNS,
) -> DataFrame:
    """(doc_id, item_id, shared, size, share, first_word, last_word) for items whose share of runs in a document is reached.

    ``first_word`` and ``last_word`` are the outermost words of the document that belong to a shared run. Rows that
    repeat a document's id count as one document.

    The measured index is broadcast, so documents are read in place and only runs that some item has become
    rows; their counts combine before the shuffle. A larger index is joined by run, and the documents of a run
    are dealt into SALTS parts, so that a run of every document isn't one task's.
    """
    index = materialize(item_index(items, n, item_id, text), "item-runs")
    told = index.groupBy("words").agg(F.count(F.lit(1)).alias("n")).collect()  # at most n rows
    sizes, total = sorted(r["words"] for r in told), sum(r["n"] for r in told)
    t = F.col("_t")
    every = F.concat(*[runs_of(t, k) for k in sizes]) if sizes else F.slice(runs_of(t, 1), 1, 0)
    rows = docs.select(F.col(doc_id).alias("doc"), tokens(dedup_text(F.col(text))).alias("_t")).where(F.size("_t") > 0)
    runs = rows.select("doc", F.explode(every).alias("r")).select("doc", "r.h", "r.first")
    if total <= broadcast_runs:
        met = runs.join(F.broadcast(index), "h")
    else:
        part = F.pmod(F.xxhash64("doc", "first"), F.lit(SALTS))
        spread = index.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = runs.withColumn("_part", part).join(spread, ["h", "_part"])
    once = met.groupBy("doc", "item", "h").agg(
        F.min("first").alias("first"), F.max(F.col("first") + F.col("words") - 1).alias("last"), F.max("size").alias("size")
    )
    found = once.groupBy("doc", "item").agg(
        F.count(F.lit(1)).alias("shared"), F.max("size").alias("size"), F.min("first").alias("first_word"), F.max("last").alias("last_word")
    )
    return found.where(F.col("shared") >= F.lit(share) * F.col("size")).select(
        F.col("doc").alias(doc_id), F.col("item").alias(item_id), "shared", "size", (F.col("shared") / F.col("size")).alias("share"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
    )


def decontaminated(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents without any found item, with all their columns; a document without an id is judged like any other."""
    gone = spans.select(F.col(doc_id).alias("_gone")).distinct()
    return docs.join(gone, F.col(doc_id).eqNullSafe(F.col("_gone")), "left_anti")


def marked_keys(keys: DataFrame, golden: DataFrame, key: str = "key", listed: int = LISTED_KEYS) -> DataFrame:
    """Adds ``hit`` to rows with a key: whether the golden set has that key too. A null key meets a null key.

    The golden keys are measured. A few become a list, so that a filter on ``hit`` over stored keys reaches
    the scan; more are joined as distinct keys, broadcast only if the planner knows them to be small.
    """
    wanted = materialize(golden.select(F.col(key).alias("_golden")).distinct(), "golden-keys")
    values = [r["_golden"] for r in wanted.limit(listed + 1).collect()]
    if len(values) <= listed:
        plain = [v for v in values if v is not None]
        hit = F.coalesce(F.col(key).isin(plain), F.lit(False)) if plain else F.lit(False)
        return keys.withColumn("hit", hit | F.col(key).isNull() if None in values else hit)
    found = keys.join(wanted, F.col(key).eqNullSafe(F.col("_golden")), "left_semi").select(F.col(key).alias("_found")).distinct()
    found = found.withColumn("hit", F.lit(True))
    joined = keys.join(found, F.col(key).eqNullSafe(F.col("_found")), "left").drop("_found")
    return joined.withColumn("hit", F.coalesce("hit", F.lit(False)))


def contaminated(keys: DataFrame, golden: DataFrame, key: str = "key", listed: int = LISTED_KEYS) -> DataFrame:
    """Only the rows whose key is golden; over stored keys and a short list the filter is pushed to the scan."""
    wanted = materialize(golden.select(F.col(key).alias("_golden")).distinct(), "golden-keys")
    values = [r["_golden"] for r in wanted.limit(listed + 1).collect()]
    if len(values) > listed:
        return keys.join(wanted, F.col(key).eqNullSafe(F.col("_golden")), "left_semi")
    plain = [v for v in values if v is not None]
    kept = F.col(key).isin(plain) if plain else F.lit(False)
    return keys.where(kept | F.col(key).isNull() if None in values else kept)


def key_report(marked: DataFrame, by: Sequence[str] = ("split",), key: str = "key") -> DataFrame:
    """(by, examples, hits, golden): rows, rows with a golden question, and different golden questions among them."""
    null_hit = F.max(F.when(F.col("hit") & F.col(key).isNull(), 1).otherwise(0))
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("examples"), F.count_if("hit").alias("hits"),
        (F.count_distinct(F.when(F.col("hit"), F.col(key))) + null_hit).alias("golden"),
    )
