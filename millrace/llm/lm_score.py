"""Language-model scores: smoothed token counts, and a hidden Markov model trained over the whole corpus.

The model draws a latent state per token, a token class from the state, and the token
from its class, so a text's probability is the HMM's for its classes times the tokens'
within their classes. The most frequent tokens (``OWN``) are classes of their own, all others
fall into ``SHARED`` classes by their last three bytes. Counts, classes and Baum-Welch
sums cover all learning documents; only the starting point of the training comes from a
bounded sample (``SAMPLE_DOCS`` segments).

Token counts grow with the corpus and stay in a table. The tasks know the counts of at most
``HEAD`` frequent tokens, broadcast (short words only, so its size is bounded); the rare tokens of each
document are joined to the table by token. A rare token can't be hot unless nothing
was learned of it, and then the inner join drops it. Baum-Welch sums have states x classes
numbers, added up per task and then by Spark.

Null text is empty: it has only its end token. Repeated rows each count and get the same
scores. With nothing to learn from, all counts are 0 and the model is uniform. Empty input
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hmm
from millrace.llm.common import LOWER_BYTES, remainder, slices, texts_of
from millrace.session import materialize

STATES, OWN, SHARED = 6, 1024, 1024
HEAD, HEAD_BYTES = 65_536, 64
SAMPLE_DOCS, SAMPLE_ROUNDS, ROUNDS = 1500, 12, 3
SMOOTH = 0.1
#: The end of a text as a token; no word is empty.
END = b""
#: Distinct tokens a task counts before it passes them on.
HELD = 300_000


def tokens(text: bytes) -> list[bytes]:
    return [*text.translate(LOWER_BYTES).split(), END]


def shared_class(token: bytes) -> int:
    return OWN + zlib.crc32(token[-3:]) % SHARED


def vocabulary(docs: DataFrame) -> DataFrame:
    """token (bytes) and its count ``c`` over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def packed() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["token", "n"])

        for batch in batches:
            for text in texts_of(batch.column(0)):
                counts.update(tokens(text))
                if len(counts) > HELD:
                    yield packed()
        yield packed()

    return docs.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


def _head(vocab: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """The most frequent short tokens with their counts, at most ``HEAD``: whole steps of an eighth of a doubling."""
    step = F.floor(F.log2("c") * 8).cast("int")
    short = vocab.where(F.octet_length("token") <= HEAD_BYTES)
    sizes = short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > HEAD:
            break
        least = r["step"]
    if least is None:
        return [], np.zeros(0)
    rows = sorted(short.where(step >= least).collect(), key=lambda r: (-r["c"], bytes(r["token"])))
    return [bytes(r["token"]) for r in rows], np.array([r["c"] for r in rows], float)


def _class_sizes(vocab: DataFrame, own: list[bytes]) -> np.ndarray:
    """What a token's smoothed count is divided by, for every class: tokens counted + 0.1 (distinct + 1), or the count itself."""
    names = {t: i for i, t in enumerate(own)}
    size = OWN + SHARED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            own_class = np.array([names.get(t, -1) for t in batch.column(0).to_pylist()], np.int64)
            rest = np.array([shared_class(t) for t in batch.column(0).to_pylist()], np.int64)
            cls = np.where(own_class >= 0, own_class, rest)
            total += np.bincount(cls, batch.column(1).to_numpy(), minlength=size).astype(np.int64)
            distinct += np.bincount(cls, minlength=size)
        some = np.flatnonzero(distinct)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some]), pa.array(distinct[some])], names=["k", "n", "v"])

    summed = vocab.select("token", "c").mapInArrow(run, "k long, n long, v long").groupBy("k").agg(F.sum("n"), F.sum("v")).collect()
    n, v = np.zeros(size), np.zeros(size)
    for k, a, b in summed:
        n[k], v[k] = a, b
    return np.where(np.arange(size) < OWN, n + SMOOTH, n + SMOOTH * (v + 1))


def _encoded(docs: DataFrame, head: list[bytes], counts: np.ndarray, norm: float) -> DataFrame:
    """Documents as classes, sums over frequent tokens, and lists of rare tokens."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((head, counts))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        (remainder(F.col("doc_id"), 10) == 0).alias("held_out"), "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, found = shared.value
        index = {t: i for i, t in enumerate(words)}
        logs = np.log10((found + SMOOTH) / norm)
        kind = np.array([i if i < OWN else shared_class(t) for i, t in enumerate(words)], np.uint16)
        for batch in batches:
            texts = texts_of(batch.column(3))
            for a, b in slices([len(t) for t in texts]):
                lists = [tokens(t) for t in texts[a:b]]
                sizes = np.array([len(x) for x in lists])
                flat = list(chain.from_iterable(lists))
                at = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, len(flat))
                owner = np.repeat(np.arange(b - a), sizes)
                known = at >= 0
                cls = np.zeros(len(flat), np.uint16)
                cls[known] = kind[at[known]] if len(kind) else 0
                rare = np.flatnonzero(~known)
                cls[rare] = [shared_class(flat[i]) for i in rare]
                ends = np.cumsum(sizes)
                rare_of = np.searchsorted(rare, np.r_[0, ends])
                counted = [Counter(flat[i] for i in rare[x:y]) for x, y in zip(rare_of, rare_of[1:])]
                heads = np.bincount(owner[known], minlength=b - a)
                sums = np.bincount(owner[known], logs[at[known]] if len(logs) else None, minlength=b - a).astype(float)
                packed = [cls[e - n : e].astype("<u2").tobytes() for e, n in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in range(3)), pa.array(sizes.astype(np.int64)),
                        pa.array(heads.astype(np.int64)), pa.array(sums), pa.array(packed, pa.binary()),
                        pa.array([list(c) for c in counted], pa.list_(pa.binary())),
                        pa.array([list(c.values()) for c in counted], pa.list_(pa.int64())),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_head", "head_sum", "classes", "rare", "times"],
                )

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_sum double, classes binary, "
        "rare array<binary>, times array<long>"
    )
    return rows.mapInArrow(run, schema)


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u2") for b in column.to_pylist()]


def _round(encoded: DataFrame, model: hmm.Model) -> hmm.Counts:
    """Baum-Welch counts of all rows: summed within each task, then by Spark over (kind, state, column)."""
    states, symbols = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = hmm.Counts.empty(states, symbols)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                hmm.expect(model, _sequences(batch.column(0).slice(a, 1000)), counts)
        whole = np.concatenate([[counts.loss], counts.start, counts.moves.ravel(), counts.emit.ravel()])
        some = np.flatnonzero(whole)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(whole[some])], names=["cell", "value"])

    summed = encoded.select("classes").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value")).collect()
    whole = np.zeros(1 + states + states * states + states * symbols)
    for cell, value in summed:
        whole[cell] = value
    start, moves, emit = np.split(whole[1:], [states, states + states * states])
    return hmm.Counts(start, moves.reshape(states, states), emit.reshape(states, symbols), whole[0])


def _train(encoded: DataFrame, rounds: int) -> hmm.Model:
    """A model begun on a bounded sample of segments and trained on all learning rows."""
    learn = encoded.where("not held_out")
    count = learn.count()
    place = F.pmod(F.xxhash64("doc_id", "row"), F.lit(1_000_003))
    width = 2 * hmm.SEGMENT
    skip = F.pmod(place, F.greatest(F.lit(1), F.floor(F.octet_length("classes") / 2) - hmm.SEGMENT + 1))
    part = F.substring("classes", (2 * skip + 1).cast("int"), F.lit(width))
    picked = learn.where(place / 1_000_003.0 < min(1.0, SAMPLE_DOCS / max(count, 1))).select(part.alias("p"), "row").collect()
    sample = [np.frombuffer(bytes(r["p"]), "<u2") for r in sorted(picked, key=lambda r: r["row"])]
    symbols = OWN + SHARED
    frequency = np.bincount(np.concatenate(sample), minlength=symbols) if sample else np.zeros(symbols)
    model = hmm.initial(frequency, STATES)
    for _ in range(SAMPLE_ROUNDS if sample else 0):
        counts = hmm.Counts.empty(STATES, symbols)
        hmm.expect(model, sample, counts)
        model = hmm.update(counts)
    for _ in range(rounds if count else 0):
        model = hmm.update(_round(learn, model))
    return model


def _likelihoods(encoded: DataFrame, model: hmm.Model, sizes: np.ndarray) -> DataFrame:
    """Rows with ``classes_log``: log10 of the classes' probability less that of the tokens' divisors."""
    divisors = np.log10(np.maximum(sizes, 1e-300))
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_head", "head_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                found = _sequences(part.column(len(kept)))
                value = hmm.log_likelihoods(model, found) / log(10)
                value -= np.array([divisors[s].sum() for s in found])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], pa.array(value)], names=[*kept, "classes_log"])

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_sum double, classes_log double"
    return encoded.select(*kept, "classes").mapInArrow(run, schema)


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    vocab = materialize(vocabulary(docs.where(remainder(F.col("doc_id"), 10) != 0)), "vocabulary")
    total, distinct = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head, counts = _head(vocab)
    norm = total + SMOOTH * (distinct + 1)
    encoded = materialize(_encoded(docs, head, counts, norm), "lm-rows")
    sizes = _class_sizes(vocab, head[:OWN])
    scored = _likelihoods(encoded, _train(encoded, rounds), sizes)
    pairs = encoded.select("row", F.inline(F.arrays_zip("rare", "times"))).withColumnsRenamed({"rare": "token", "times": "n"})
    met = pairs.join(vocab, "token").groupBy("row").agg(
        F.sum("n").alias("met"), F.sum(F.col("n") * F.log10((F.col("c") + SMOOTH) / norm)).alias("met_sum")
    )
    joined = scored.join(met, "row", "left").na.fill(0, ["met"]).na.fill(0.0, ["met_sum"])
    unseen = F.col("n_tokens") - F.col("n_head") - F.col("met")
    base = F.col("head_sum") + F.col("met_sum") + unseen * F.lit(log10(SMOOTH / norm))
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_head") + F.col("met")).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("n_tokens") * F.lit(log10(norm)) + F.col("classes_log")).alias("score"),
    )
