"""Target-distribution importance resampling over hashed n-gram features.

Every document is weighed by how much likelier its features are in the target texts than in
the whole corpus, and the documents with the highest perturbed weights are drawn. Features are
runs of words; a feature's bucket is the CRC-32 of its bytes modulo the number of buckets,
computed for all features of a slice of texts at once (see ``crc.py``).

The corpus is read twice, once for the bucket counts and once for the weights. A task counts into
one array of ``buckets`` numbers, so what is shuffled is at most ``buckets`` rows a task, whatever
the texts hold and however often a word stands in them; the gains are ``buckets`` numbers, which is
what the driver and every task hold (the caller's parameter bounds them). Ranks come from one range
sort of narrow rows and a table with one row per partition.

A null text has no words: no features, weight 0, and it is never drawn unless ``least_words`` is 0.
Empty texts likewise. A very long text is handled in chunks of its words. Rows that repeat are
counted, weighed and drawn each; of rows with the same score and id which one comes first is not
told apart. An id that is null counts as the empty text for its noise and sorts first. An empty
corpus gives no rows; without target texts every gain is that of buckets never seen. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_BYTES, ranges, slices, texts_of
from millrace.llm.crc import crc32_spans
from millrace.session import materialize

#: Bytes of features that are hashed at a time.
CHUNK_BYTES = 4 << 20
#: Lower bits of a generated row number: the place within its partition.
PLACE_BITS = 33
SPACE = 0x20


@dataclass(frozen=True)
class Resampling:
    """Features are runs of ``shortest`` to ``longest`` words."""

    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024


def _word_bytes() -> np.ndarray:
    """Digits, small letters and all bytes of characters beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


WORD = _word_bytes()


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts lower-cased in one byte array; the start, length and text number of every word."""
    data = np.frombuffer(b"\n".join(texts).translate(LOWER_BYTES), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    limits = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, ends - starts, np.searchsorted(limits, starts, side="right")


def features(texts: list[bytes], rules: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all features of the texts, in chunks of about CHUNK_BYTES."""
    data, starts, lengths, owner = words_of(texts)
    if rules.longest > 1:
        # words one after the other with one space between, so that every run of words is one span
        packed = np.full(int(lengths.sum()) + len(lengths), SPACE, np.uint8)
        begins = np.cumsum(lengths + 1) - lengths - 1
        packed[ranges(begins, lengths)] = data[ranges(starts, lengths)]
        data, starts = packed, begins
    for n in range(rules.shortest, rules.longest + 1):
        last = len(starts) - n + 1
        if last <= 0:
            return
        sizes = starts[n - 1 :] + lengths[n - 1 :] - starts[:last]
        whole = np.flatnonzero(owner[:last] == owner[n - 1 :])
        done = np.cumsum(sizes[whole])
        cuts = np.searchsorted(done, np.arange(CHUNK_BYTES, int(done[-1]) if len(done) else 0, CHUNK_BYTES), side="right")
        for part in np.split(whole, np.unique(cuts)):
            if len(part):
                yield owner[part], crc32_spans(data, starts[part], sizes[part]) % rules.buckets


def bucket_counts(texts: DataFrame, rules: Resampling = Resampling(), text: str = "text") -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(rules.buckets, np.int64)
        for batch in batches:
            raw = texts_of(batch.column(0))
            for a, b in slices([len(x) for x in raw]):
                for _, bucket in features(raw[a:b], rules):
                    counts += np.bincount(bucket, minlength=rules.buckets)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["bucket", "n"])

    parts = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, rules: Resampling = Resampling()) -> np.ndarray:
    """Thousandths of the log ratio of target and corpus shares of every bucket, both smoothed by one.

    Takes two tables of bucket counts, collects at most ``buckets`` rows of each.
    """
    seen = np.zeros((2, rules.buckets), np.int64)
    for row, counts in zip(seen, (corpus, target)):
        for bucket, n in counts.collect():
            row[bucket] = n
    s, t = seen.tolist()
    all_s, all_t = sum(s) + rules.buckets, sum(t) + rules.buckets
    return np.array(
        [math.floor(1000 * math.log(float(y + 1) * float(all_s) / (float(x + 1) * float(all_t)))) for x, y in zip(s, t)], np.int64
    )


def weigh(docs: DataFrame, gain: np.ndarray, rules: Resampling = Resampling(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_words, n_features and weight, the sum of the gains of the features, of every row."""
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    # sums of gains are added as doubles: whole numbers far below 2**53
    worth = gain.astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts_of(batch.column(1))
            for a, b in slices([len(x) for x in raw]):
                part = raw[a:b]
                n, weight = np.zeros(b - a, np.int64), np.zeros(b - a)
                for owner, bucket in features(part, rules):
                    n += np.bincount(owner, minlength=b - a)
                    weight += np.bincount(owner, worth[bucket], minlength=b - a)
                words = n if rules.longest == 1 else np.bincount(words_of(part)[3], minlength=b - a)
                out = [batch.column(0).slice(a, b - a), *map(pa.array, (words.astype(np.int64), n, weight.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(out, names=["key", "n_words", "n_features", "weight"])

    made = rows.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")
    return made.withColumnRenamed("key", key)


def perturbed(weighed: DataFrame, rules: Resampling = Resampling(), key: str = "doc_id") -> DataFrame:
    """Adds ``score``: the weight and noise told by the id, so that the highest scores are a draw by weight."""
    name = F.concat(F.lit(f"{rules.seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def draw(scored: DataFrame, rules: Resampling = Resampling(), key: str = "doc_id") -> DataFrame:
    """Adds ``rank``: 1, 2, 3... for the drawn rows by falling score and rising id, null for the others.

    Rows are sorted over all tasks by (may be drawn, score, id); a last sort column deals rows that agree in
    all of them over tasks. A row's rank is its place in its partition and the rows of the partitions before.
    """
    able = F.col("n_words") >= rules.least_words
    stored = materialize(scored, "scores").withColumn("_tie", F.monotonically_increasing_id())
    ordered = stored.orderBy((~able).cast("int"), F.col("score").desc(), F.col(key).asc_nulls_first(), "_tie")
    placed = materialize(ordered.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", PLACE_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    every = Window.partitionBy(F.lit(1))
    parts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"), F.count_if(able).alias("_able")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.floor(F.sum("_able").over(every) * rules.percent / 100).alias("_drawn"),
    )
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << PLACE_BITS) - 1) + 1
    joined = placed.withColumn("_part", part).join(F.broadcast(parts), "_part")
    return joined.withColumn("rank", F.when(rank <= F.col("_drawn"), rank)).select(*scored.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, rules: Resampling = Resampling(), key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with n_words, n_features, weight, score and, if drawn, its rank."""
    gain = gains(bucket_counts(docs, rules), bucket_counts(target, rules), rules)
    return draw(perturbed(weigh(docs, gain, rules, key), rules, key), rules, key)


def oracle(rules: Resampling = Resampling()) -> str:
    """DuckDB statement for features of one word over ``documents`` and ``benchmark``."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    size = rules.buckets
    return f"""
WITH crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))),
doc_words AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, {words} AS ws FROM documents),
corpus AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM doc_words) GROUP BY 1),
target AS (SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY 1),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM corpus UNION SELECT word FROM target)),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295) % {size} AS bucket
  FROM hexed, crc_table),
s AS (SELECT bucket, sum(n) AS n FROM corpus JOIN hashed USING (word) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS n FROM target JOIN hashed USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {size})::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {size})::DOUBLE))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket)),
weights AS (
  SELECT row_id, sum(g) AS weight FROM (SELECT row_id, unnest(ws) AS word FROM doc_words) JOIN hashed USING (word) JOIN gain USING (bucket)
  GROUP BY 1),
scored AS (
  SELECT row_id, doc_id, len(ws) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST('0x' || sha256('{rules.seed}:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
  FROM doc_words LEFT JOIN weights USING (row_id)),
noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296.0::DOUBLE))) AS BIGINT) AS score, n_features >= {rules.least_words} AS able
  FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS FIRST) AS k,
    count(*) FILTER (able) OVER () * {rules.percent} // 100 AS drawn
  FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND k <= drawn THEN k END AS rank FROM ranked"""
