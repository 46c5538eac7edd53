"""Quality rules: counts over whole texts, and a line labelling by a linear-chain CRF.

Every ``\\n``-split line of a text is described by yes/no features (length, capitals,
symbols, repeats and so on). The field has the labels content and boilerplate; Viterbi
decoding labels the lines of a text together, and the share of words that stand in
content lines decides whether the text is kept.

The field is fitted on the driver on a bounded sample of labelled documents
(``SAMPLE_DOCS`` and ``SAMPLE_LINES``, chosen by hash). A document's quality is the
label of all its lines; only a bit pattern per line travels. Measuring reads each text
once, row by row, without a shuffle.

Null text has no words: all counts are 0 and it fails the base rules. So does an empty
text. A very long text is read in pieces and labelled in blocks of about the square root of its
lines, in time about linear in its length and some fifty bytes of memory for each of its own; the result is that of
one pass, since scores are whole numbers. Repeated rows give repeated results. Without labels of both kinds there is no
field and the base rules decide alone. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import retain, slices, texts_of

#: Most documents of each label in the fitting sample, and lines of each (a stretch at a hashed place).
SAMPLE_DOCS, SAMPLE_LINES = 1500, 96
FEATURES = 22
WINDOW = 8
#: Long texts are read in pieces of about this many bytes, and labelled in blocks beyond so many lines.
PIECE, BLOCK = 1 << 20, 4096
#: Scores are whole multiples of 1 / UNIT.
UNIT = 1 << 20
_BREAK, _SPACE = re.compile(rb"\n"), re.compile(rb"[\t-\r ]")

_KINDS = np.zeros(256, np.uint8)
for _kind, _chars in enumerate(
    (b" \t\n\r\x0b\x0c", b"#*$%&|<>", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b"!?", b".,;:"), 1
):
    _KINDS[list(_chars)] = _kind
_KINDS[0x80:0xC0] = 8
_KINDS[0xC0:] = 9
SPACE, SYMBOL, UPPER, LOWER, DIGIT, SHOUT, STOP, TAIL, WIDE = range(1, 10)


@dataclass
class Lines:
    """Lines of a run of texts, flat: the text of each, its words, whether it repeats an earlier one, its features."""

    owner: np.ndarray
    words: np.ndarray
    repeats: np.ndarray
    bits: np.ndarray


def _pieces(data: bytes, cut: re.Pattern[bytes], most: int = PIECE) -> Iterator[bytes]:
    """The data in pieces that end behind a match of ``cut``, the first one ``most`` bytes on."""
    at = 0
    while at < len(data):
        found = cut.search(data, at + most)
        end = found.end() if found else len(data)
        yield data[at:end]
        at = end


def _hashes(found: Iterator[list[bytes]]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(hash, x), np.int64, len(x)) for x in found)])


def _first_alike(keys: np.ndarray, value: Callable[[int], tuple]) -> np.ndarray:
    """For every item the number of the first one of the same value: equal keys find candidates, values decide."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    order = order.astype(np.int32)
    first = np.arange(len(keys), dtype=np.int32)
    heads = np.flatnonzero(np.r_[True, ~same]) if len(keys) else order
    sizes = np.diff(np.r_[heads, len(keys)])
    for a, n in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        known: dict[tuple, int] = {}
        for at in range(a, a + n):
            item = int(order[at])
            first[item] = known.setdefault(value(item), item)
    return first


def _counts(texts: list[bytes]) -> tuple[dict[str, np.ndarray], Lines]:
    """The base counts of every text, and its lines."""
    data = b"\n".join(texts) + b"\n"
    flat = np.frombuffer(data, np.uint8)
    kinds = _KINDS[flat]
    breaks = np.flatnonzero(flat == 10)
    starts = np.r_[0, breaks[:-1] + 1]
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    owner = np.searchsorted(text_ends, starts).astype(np.int32)

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int64)

    space = kinds == SPACE
    # positions in a run of texts fit 32 bits
    word_starts = np.flatnonzero(~space & np.r_[True, space[:-1]]).astype(np.int32)
    word_ends = np.flatnonzero(~space & np.r_[space[1:], True]).astype(np.int32) + 1
    behind = np.searchsorted(word_starts, breaks)
    words = np.diff(np.r_[0, behind])
    counted = {k: per_line(kinds == k) for k in (SYMBOL, UPPER, LOWER, DIGIT, SHOUT, STOP, WIDE)}
    chars = per_line(~space & (kinds != TAIL))
    bars = per_line(flat == ord("|"))
    del kinds, space
    full = np.flatnonzero(words)
    final = np.zeros(len(starts), np.uint8)
    final[full] = flat[word_ends[behind[full] - 1] - 1]
    mix = np.uint64(0x9E3779B97F4A7C15)
    lines = _hashes(p.split(b"\n")[:-1] for p in _pieces(data, _BREAK))[full].astype(np.uint64) ^ owner[full].astype(np.uint64) * mix
    first = _first_alike(lines, lambda i: (owner[full[i]], data[starts[full[i]] : breaks[full[i]]]))
    repeats = np.zeros(len(starts), bool)
    repeats[full] = first != np.arange(len(full))
    del lines, first
    hashes = _hashes(p.split() for p in _pieces(data, _SPACE)).astype(np.uint64)
    line_of = np.repeat(np.arange(len(words), dtype=np.int32), words)
    varied = _varied(hashes, line_of, words)
    n = np.maximum(chars, 1)
    w = np.maximum(words, 1)
    letters = np.maximum(counted[UPPER] + counted[LOWER] + counted[WIDE], 1)
    symbols, capitals = counted[SYMBOL] / w, counted[UPPER] / letters
    tests = [
        np.ones(len(n), bool), words == 0, (words > 0) & (words < 4), (words >= 4) & (words < 10), words >= 10, words >= 40,
        symbols > 0.02, symbols > 0.15, symbols > 0.5, symbols > 1.5, capitals > 0.2, capitals > 0.5, capitals > 0.8,
        counted[SHOUT] / w > 0.1, counted[SHOUT] / w > 0.5, counted[DIGIT] / n > 0.15, repeats, varied < 0.5,
        bars >= 2, n / w > 12, n / w < 2.5, (final == ord(".")),
    ]
    bits = np.zeros(len(n), np.int64)
    for i, test in enumerate(tests):
        bits |= test.astype(np.int64) << i

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, minlength=len(texts)).astype(np.int64)

    base = {
        "n_words": per_text(words), "word_chars": per_text(chars), "n_symbols": per_text(counted[SYMBOL]),
        "n_dup_lines": per_text(repeats),
        "n_repeat_words": _repeat_words(data, hashes, word_starts, word_ends, owner[line_of], len(texts)),
    }
    return base, Lines(owner, words, repeats, bits)


def _varied(hashes: np.ndarray, line_of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Different words of a line to all its words, for lines of more than three; words are told by 64-bit hashes."""
    out = np.ones(len(words))
    asked = words[line_of] > 3
    hashes, line_of = hashes[asked], line_of[asked]
    order = np.lexsort((hashes, line_of))
    hashes = hashes[order]  # the lines are in order already
    fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (line_of[1:] != line_of[:-1])][: len(hashes)]
    found = np.bincount(line_of[fresh], minlength=len(words))
    out[words > 3] = found[words > 3] / words[words > 3]
    return out


def _repeat_words(
    data: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, own: np.ndarray, texts: int
) -> np.ndarray:
    """Words in windows of eight that stand twice or more in their text; windows' hashes find candidates, their words decide."""
    total = len(hashes)
    if total < WINDOW:
        return np.zeros(texts, np.int64)
    n = total - WINDOW + 1
    key = own[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(WINDOW):
        key ^= hashes[i : i + n]
        key *= np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    inside = np.flatnonzero(own[:n] == own[WINDOW - 1 :]).astype(np.int32)
    key = key[inside]

    def window(i: int) -> tuple:
        at = inside[i]
        return own[at], b" ".join(data[starts[at] : ends[at + WINDOW - 1]].split())

    first = _first_alike(key, window)
    twice = first != np.arange(len(inside))
    twice[first[twice]] = True
    covered = np.zeros(total + 1, np.int32)
    covered[inside[twice]] += 1
    covered[inside[twice] + WINDOW] -= 1
    marked = np.cumsum(covered)[:total] > 0
    return np.bincount(own[marked], minlength=texts).astype(np.int64)


@dataclass(frozen=True)
class Field:
    """Weights of the field (label 1 is content), and the share of content words from which a text is kept."""

    weights: np.ndarray
    moves: np.ndarray
    share: float = 0.5

    def scores(self, bits: np.ndarray) -> np.ndarray:
        return self.units(bits) / UNIT

    def units(self, bits: np.ndarray) -> np.ndarray:
        """Scores of lines in whole units of 1 / UNIT, so that sums are exact in any order; two tables of half the bits."""
        half = FEATURES // 2
        on = (np.arange(1 << half)[:, None] >> np.arange(half)) & 1
        weights = np.rint(self.weights * UNIT).astype(np.int64)
        return (on @ weights[:half])[bits & ((1 << half) - 1)] + (on @ weights[half:])[bits >> half]

    def viterbi(self, owner: np.ndarray, bits: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """The best labels of all lines; of equally good ones, the earlier line's label is 0 seen from the end.

        Texts of up to ``block`` lines run side by side, line by line; longer ones block by block.
        """
        scores, moves = self.units(bits), np.rint(self.moves * UNIT).astype(np.int64)
        labels = np.zeros(len(bits), np.int8)
        starts = np.flatnonzero(np.r_[True, np.diff(owner) != 0])[: len(bits)]
        sizes = np.diff(np.r_[starts, len(owner)])
        for a, n in zip(starts[sizes > block].tolist(), sizes[sizes > block].tolist()):
            labels[a : a + n] = _by_blocks(scores[a : a + n], moves)
        starts, sizes = starts[sizes <= block], sizes[sizes <= block]
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        if not len(sizes):
            return labels
        longest = int(sizes[0])
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")
        best = scores[starts]
        back = []
        for t in range(1, longest):
            n = active[t]
            step = best[:n, :, None] + moves
            back.append(step.argmax(1).astype(np.int8))
            best[:n] = step.max(1) + scores[starts[:n] + t]
        state = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            n = active[t]
            labels[starts[:n] + t] = state[:n]
            if t:
                state[:n] = back[t - 1][np.arange(n), state[:n]]
        return labels


def _by_blocks(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best labels of one long text: about sqrt(n) blocks of sqrt(n) lines, all blocks stepped together.

    Every block's 2x2 max-plus product gives what enters the next one; then the blocks' own steps leave
    back pointers, and the blocks' maps from last to first label lead back. The first line stands before all blocks.
    """
    count = len(scores) - 1
    width = max(1, isqrt(count))
    number = -(-count // width)
    steps = np.zeros((number * width, 2), np.int64)
    steps[:count] = scores[1:]
    steps = steps.reshape(number, width, 2)
    live = (np.arange(number * width) < count).reshape(number, width)
    product = moves + steps[:, 0, None, :]
    for t in range(1, width):
        longer = (product[:, :, :, None] + moves).max(2) + steps[:, t, None, :]
        product = np.where(live[:, t, None, None], longer, product)
    best = np.empty((number, 2), np.int64)
    best[0] = scores[0]
    for b in range(1, number):
        best[b] = (best[b - 1][:, None] + product[b - 1]).max(0)
    back = np.tile(np.array([0, 1], np.int8), (number, width, 1))
    for t in range(width):
        step = best[:, :, None] + moves
        on = live[:, t]
        back[on, t] = step.argmax(1)[on]
        best[on] = step.max(1)[on] + steps[on, t]
    blocks = np.arange(number)
    entry = np.tile(np.array([0, 1], np.int8), (number, 1))
    for t in range(width - 1, -1, -1):
        entry = back[blocks[:, None], t, entry]
    state = np.empty(number, np.int8)
    state[-1] = best[-1].argmax()
    for b in range(number - 1, 0, -1):
        state[b - 1] = entry[b, state[b]]
    labels = np.empty((number, width), np.int8)
    for t in range(width - 1, -1, -1):
        labels[:, t] = state
        state = back[blocks, t, state]
    return np.r_[state[:1], labels.reshape(-1)[:count]]


def fit(samples: list[tuple[int, np.ndarray]], rounds: int = 150, ridge: float = 1e-3) -> Field | None:
    """Maximum likelihood by forward and backward sums over all sample texts at once; None without both labels."""
    samples = [(y, b) for y, b in samples if len(b)]
    if len({y for y, _ in samples}) < 2:
        return None
    samples.sort(key=lambda s: -len(s[1]))
    longest = len(samples[0][1])
    bits = np.zeros((len(samples), longest), np.int64)
    live = np.zeros(bits.shape, bool)
    for i, (_, b) in enumerate(samples):
        bits[i, : len(b)], live[i, : len(b)] = b, True
    gold = np.array([y for y, _ in samples])
    weigh = np.where(gold == 1, 0.5 / max(1, gold.sum()), 0.5 / max(1, (1 - gold).sum()))  # both labels count alike
    weigh = weigh / live.sum(1)
    on = ((bits[..., None] >> np.arange(FEATURES)) & 1).astype(float) * live[..., None]
    active = [int(live[:, t].sum()) for t in range(longest)]
    one_hot = np.eye(2)[gold]
    seen = np.einsum("nk,ntf,n->fk", one_hot, on, weigh)
    seen_moves = np.einsum("nk,nl,n->kl", one_hot, one_hot, weigh * (live.sum(1) - 1))
    params = [np.zeros((FEATURES, 2)), np.zeros((2, 2))]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    for step in range(1, rounds + 1):
        scores = np.exp(on @ params[0])
        moves = np.exp(params[1])
        ahead = np.empty(scores.shape)
        ahead[:, 0] = scores[:, 0] / scores[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            n = active[t]
            value = ahead[:n, t - 1] @ moves * scores[:n, t]
            ahead[:n, t] = value / value.sum(1, keepdims=True)
        behind = np.ones((len(samples), 2))
        want, want_moves = np.zeros((FEATURES, 2)), np.zeros((2, 2))
        for t in range(longest - 1, -1, -1):
            n = active[t]
            mass = ahead[:n, t] * behind[:n]
            mass /= mass.sum(1, keepdims=True)
            want += on[:n, t].T @ (mass * weigh[:n, None])
            if t:
                right = scores[:n, t] * behind[:n]
                both = ahead[:n, t - 1, :, None] * moves * right[:, None, :]
                both /= both.sum((1, 2), keepdims=True)
                want_moves += (both * weigh[:n, None, None]).sum(0)
                back = right @ moves.T
                behind[:n] = back / back.sum(1, keepdims=True)
        for i, slope in enumerate((seen - want - ridge * params[0], seen_moves - want_moves - 0.02 * params[1])):
            m, v = moments[i]
            m[:] = 0.9 * m + 0.1 * slope
            v[:] = 0.99 * v + 0.01 * slope**2
            params[i] = params[i] + 0.1 * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(params[0], params[1])


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    """A field from documents with a quality label, on a bounded sample of both kinds."""
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return None
    place = F.xxhash64("doc_id")
    share = F.when(F.col("quality") == 1, SAMPLE_DOCS / sizes[1]).otherwise(SAMPLE_DOCS / sizes[0])
    chosen = known.where((F.pmod(place, F.lit(1_000_003)) / 1_000_003.0) < share).dropDuplicates(["doc_id"])
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about 2 SAMPLE_DOCS ids
    rows = rows.select("doc_id", "quality", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            for start, stop in slices([len(t) for t in texts]):
                lines = _counts(texts[start:stop])[1]
                out = []
                for i, text in enumerate(texts[start:stop]):
                    a, b = np.searchsorted(lines.owner, [i, i + 1])
                    skip = len(text) % max(1, b - a - SAMPLE_LINES + 1)
                    out.append(lines.bits[a + skip : min(b, a + skip + SAMPLE_LINES)].astype("<i4").tobytes())
                columns = [batch.column(i).slice(start, stop - start) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=["doc_id", "quality", "bits"])

    # rows that repeat an id give one sample
    found = rows.mapInArrow(run, f"doc_id {kind}, quality int, bits binary").groupBy("doc_id").agg(F.min(F.struct("quality", "bits")).alias("s"))
    samples = sorted((r.s["quality"], bytes(r.s["bits"])) for r in found.select("s").collect())
    return fit([(y, np.frombuffer(b, "<i4").astype(np.int64)) for y, b in samples])


def measure(texts: list[bytes], field: Field | None) -> dict[str, np.ndarray]:
    """Counts, share of words in content lines, and verdict of every text."""
    base, lines = _counts(texts)
    n = base["n_words"]
    base["base_failed"] = (n < 20) | (100 * base["n_repeat_words"] > 30 * n)
    if field is None:
        share = np.ones(len(texts))
    else:
        content = field.viterbi(lines.owner, lines.bits) == 1
        share = np.bincount(lines.owner, lines.words * content, minlength=len(texts)) / np.maximum(n, 1)
    base["content_share"] = share
    base["kept"] = ~base["base_failed"] & (share >= (field.share if field else 0))
    return base


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


def judge(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id with counts, content share and verdict."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices([len(t) for t in texts]):
                found = measure(texts[a:b], field)
                columns = [batch.column(0).slice(a, b - a), *(pa.array(found[c]) for c in names)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    return rows.mapInArrow(run, f"doc_id long, {COLUMNS}")


def keep_good(docs: DataFrame, field: Field | None) -> DataFrame:
    """The documents the rules accept."""
    return retain(docs, lambda texts: measure(texts, field)["kept"])
