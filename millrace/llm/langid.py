"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrent layers read the lower-cased UTF-8 bytes of a text, one from each end, and
every position gets a probability for each language from both states. A text's
probabilities are the means over all its positions. Whole texts are read, cut into
windows of ``WINDOW`` bytes that the network reads side by side.

The network is trained in numpy by backpropagation through time, on the driver, on a
bounded sample of labelled texts (``SAMPLE_WINDOWS`` windows for each language, fewer from
``FULL_LANGUAGES`` languages on, one window at a hashed place of each sampled text). All
languages that occur are learned. It has a few thousand weights, which travel with the tasks. Prediction reads each text once,
row by row, without a shuffle.

A text that is null, empty or without a letter is ``und`` with score 0. So is every text
if there is nothing to learn from. Repeated rows give repeated results. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_BYTES, remainder, retain, slices, texts_of

WINDOW, HIDDEN = 128, 8
SAMPLE_WINDOWS, FULL_LANGUAGES = 1024, 128
STEPS, BATCH, RATE = 200, 128, 0.02
UNKNOWN = "und"
#: Bytes of which noise is made that looks like an encoded file.
ENCODED = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Windows that run side by side; their states stay in a core's cache.
SIDE_BY_SIDE = 4096
LETTER = regex.compile(r"\p{L}")


@dataclass
class Layer:
    """One direction: byte table (256 x 3H), recurrent weights (3H x H), recurrent bias; gate order z, r, n."""

    table: np.ndarray
    loop: np.ndarray
    bias: np.ndarray


@dataclass
class Network:
    names: list[str]
    layers: tuple[Layer, Layer]
    out: tuple[np.ndarray, np.ndarray]  # languages x H, for each direction
    shift: np.ndarray

    def probabilities(self, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums over the positions of every window of the languages' probabilities; windows are bytes, padded on the right."""
        count, steps = windows.shape
        total = np.zeros((len(self.names), count), np.float32)
        ahead = np.empty((steps, len(self.names), count), np.float32)
        by_step = np.ascontiguousarray(windows.T)
        for direction, (layer, out) in enumerate(zip(self.layers, self.out)):
            h = np.zeros((HIDDEN, count), np.float32)
            gates = np.repeat(np.float32([0.5, 0.5, 1.0]), HIDDEN)[:, None]
            table = np.ascontiguousarray((layer.table + np.r_[layer.bias[: 2 * HIDDEN], np.zeros(HIDDEN)]).T * gates, np.float32)
            loop = np.ascontiguousarray(layer.loop * gates, np.float32)
            bias = layer.bias[2 * HIDDEN :, None].astype(np.float32)
            out = out.astype(np.float32)
            shift = self.shift[:, None].astype(np.float32)
            for t in range(steps) if direction == 0 else range(steps - 1, -1, -1):
                x = table.take(by_step[t], axis=1)
                u = loop @ h
                x[: 2 * HIDDEN] += u[: 2 * HIDDEN]
                zr = np.tanh(x[: 2 * HIDDEN], out=x[: 2 * HIDDEN])  # a sigmoid is a stretched tanh
                zr *= 0.5
                zr += 0.5
                u = u[2 * HIDDEN :]
                u += bias
                u *= zr[HIDDEN:]
                u += x[2 * HIDDEN :]
                n = np.tanh(u, out=u)
                h -= n
                h *= zr[:HIDDEN]
                h += n
                live = t < sizes
                if direction == 0:
                    ahead[t] = out @ h
                else:
                    h *= live  # reading backward starts at the window's last byte
                    p = out @ h
                    p += ahead[t]
                    p += shift
                    np.exp(p, out=p)
                    p /= p.sum(0)
                    p *= live
                    total += p
        return total.T

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language of every text and its mean probability; empty texts get probability 0."""
        lengths = np.array([len(t) for t in texts])
        pieces = -(-lengths // WINDOW)
        flat = np.frombuffer(b"".join(t.ljust(n * WINDOW, b" ") for t, n in zip(texts, pieces)).translate(LOWER_BYTES), np.uint8)
        windows = flat.reshape(-1, WINDOW)
        owner = np.repeat(np.arange(len(texts)), pieces)
        sizes = np.full(len(windows), WINDOW)
        last = np.cumsum(pieces) - 1
        sizes[last[pieces > 0]] = (lengths - (pieces - 1) * WINDOW)[pieces > 0]
        sums = np.zeros((len(texts), len(self.names)))
        together = max(1, SIDE_BY_SIDE * FULL_LANGUAGES // max(FULL_LANGUAGES, len(self.names)))
        for a in range(0, len(windows), together):
            part = slice(a, a + together)
            np.add.at(sums, owner[part], self.probabilities(windows[part], sizes[part]))
        means = sums / np.maximum(lengths, 1)[:, None]
        return means.argmax(1), np.clip(means.max(1), 0, 1)


def train(samples: list[tuple[str, bytes]], seed: int = 7) -> Network | None:
    """Minimise the mean cross-entropy of all positions with Adam; languages count alike."""
    names = sorted({lang for lang, _ in samples})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    parts = {lang: b"".join(b.translate(LOWER_BYTES)[:WINDOW].ljust(WINDOW, b" ") for x, b in sorted(samples) if x == lang) for lang in names}
    own = [np.frombuffer(parts[lang], np.uint8).reshape(-1, WINDOW) for lang in names]
    H, L = HIDDEN, len(names)
    params = []
    for _ in range(2):
        params += [rng.normal(0, 0.3, (256, 3 * H)), rng.normal(0, 0.3, (3 * H, H)), np.zeros(3 * H)]
    params += [rng.normal(0, 0.3, (L, H)), rng.normal(0, 0.3, (L, H)), np.zeros(L)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    each = max(1, BATCH // L)
    steps = STEPS * max(1, -(-L // BATCH))
    for step in range(1, steps + 1):
        # a batch has all languages as long as they fit
        shown = np.arange(L) if L <= BATCH else rng.choice(L, BATCH, replace=False)
        x = np.concatenate([own[i][rng.integers(0, len(own[i]), each)] for i in shown])
        y = np.repeat(shown, each)
        for p, (m, v), g in zip(params, moments, _slopes(params, x, y)):
            size = np.sqrt((g**2).sum())
            g = g / max(1.0, size / 5)
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g**2
            rate = RATE * (1 - step / (steps + 20))
            p -= rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    layers = tuple(Layer(*params[3 * i : 3 * i + 3]) for i in range(2))
    return Network(names, layers, (params[6], params[7]), params[8])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _slopes(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over all positions, back through every step of both directions."""
    count, steps = x.shape
    H = HIDDEN
    states, kept = [], []
    for d in range(2):
        table, loop, bias = params[3 * d : 3 * d + 3]
        h = np.zeros((count, H))
        seen, inner = np.empty((steps, count, H)), [None] * steps
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            u = h @ loop.T + bias
            a = table[x[:, t]]
            zr = _sigmoid(a[:, : 2 * H] + u[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(a[:, 2 * H :] + r * u[:, 2 * H :])
            inner[t] = (h, z, r, n, u[:, 2 * H :])
            h = n + z * (h - n)
            seen[t] = h
        states.append(seen)
        kept.append(inner)
    logits = states[0] @ params[6].T + states[1] @ params[7].T + params[8]
    p = np.exp(logits - logits.max(2, keepdims=True))
    p /= p.sum(2, keepdims=True)
    p[:, np.arange(count), y] -= 1
    p /= count * steps
    slopes: list[np.ndarray] = []
    for d in range(2):
        table, loop, _ = params[3 * d : 3 * d + 3]
        up = p @ params[6 + d]
        g_table, g_loop, g_bias = np.zeros_like(table), np.zeros_like(loop), np.zeros(3 * H)
        back = np.zeros((count, H))
        pulls = np.empty((steps, count, 3 * H))
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            h, z, r, n, un = kept[d][t]
            back = back + up[t]
            dn = back * (1 - z) * (1 - n**2)
            dz = back * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            pulls[t, :, :H], pulls[t, :, H : 2 * H], pulls[t, :, 2 * H :] = dz, dr, dn
            du = np.concatenate([dz, dr, dn * r], axis=1)
            g_loop += du.T @ h
            g_bias += du.sum(0)
            back = back * z + du @ loop
        flat = x.T.reshape(-1)
        for k in range(3 * H):
            g_table[:, k] = np.bincount(flat, pulls[:, :, k].reshape(-1), minlength=256)
        slopes += [g_table, g_loop, g_bias]
    slopes += [np.einsum("tnl,tnh->lh", p, states[0]), np.einsum("tnl,tnh->lh", p, states[1]), p.sum((0, 1))]
    return slopes


def noise(parts: list[bytes], most: int) -> list[bytes]:
    """Windows that no language wrote: the bytes of sampled windows in random order, random words, encoded bytes."""
    rng = np.random.default_rng(0)
    made = []
    for i, k in enumerate(rng.permutation(len(parts))[:most].tolist()):
        n = len(parts[k])
        if i % 3 == 0:
            made.append(rng.permutation(np.frombuffer(parts[k], np.uint8)).tobytes())
        elif i % 3 == 1:
            made.append(np.where(rng.random(n) < 0.17, 0x20, rng.integers(0x61, 0x7B, n)).astype(np.uint8).tobytes())
        else:
            made.append(rng.choice(np.frombuffer(ENCODED, np.uint8), n).tobytes())
    return made


def train_on(docs: DataFrame, with_noise: bool = False) -> Network | None:
    """A network from the documents whose crc32(doc_id) leaves a remainder other than 0 by 5.

    ``with_noise`` adds ``und`` as a label of its own, learned from noise made of as many windows as a language
    has: a network for filtering, which can tell that a text is in none of the languages.
    """
    known = docs.where(remainder(F.col("doc_id"), 5) != 0).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not sizes:
        return None
    most = max(1, SAMPLE_WINDOWS * FULL_LANGUAGES // max(FULL_LANGUAGES, len(sizes)))
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, max(1.3 * most, most + 20) / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003))
    chosen = known.where(place / 1_000_003.0 < F.coalesce(share[F.col("lang")], F.lit(0.0)))
    start = F.pmod(place, F.greatest(F.length("text") - WINDOW, F.lit(1))) + 1
    rows = chosen.select("lang", F.substr("text", start.cast("int"), F.lit(WINDOW)).alias("part"), place.alias("place"), "doc_id")
    found = sorted((r["place"], r["doc_id"] or 0, r["lang"], r["part"].encode()) for r in rows.collect())
    taken: dict[str, list[bytes]] = {}
    for _, _, lang, part in found:
        if LETTER.search(part.decode()) and len(taken.setdefault(lang, [])) < most:
            taken[lang].append(part)
    if with_noise and taken:
        whole = [p for parts in taken.values() for p in parts if len(p) >= WINDOW // 2]
        taken[UNKNOWN] = noise(whole, max(map(len, taken.values())))
    return train([(lang, part) for lang, parts in taken.items() for part in parts])


def identify(texts: list[bytes], network: Network | None) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    if network is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    worded = np.array([bool(LETTER.search(t.decode())) for t in texts], bool)
    best, score = network.predict(texts)
    return [network.names[i] if w else UNKNOWN for i, w in zip(best, worded)], np.where(worded, score, 0.0)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            for a, b in slices([len(t) for t in texts]):
                langs, score = identify(texts[a:b], network)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(langs, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, network: Network | None) -> DataFrame:
    """The documents, with all their columns, that are in a learned language.

    A text without a letter goes. With a network that has learned noise, a text of a whole window or more goes if
    noise is likelier than all languages together over all its positions; a shorter one says too little and stays.
    So a text in several learned languages stays, although none has most of it. Without a network nothing is known
    and nothing stays.
    """

    def keeps(texts: list[bytes]) -> np.ndarray:
        if network is None:
            return np.zeros(len(texts), bool)
        worded = np.array([bool(LETTER.search(t.decode())) for t in texts], bool)
        best, share = network.predict(texts)
        noisy = np.array([network.names[i] == UNKNOWN for i in best], bool) & (share > 0.5)
        return worded & ~(noisy & (np.array([len(t) for t in texts]) >= WINDOW))

    return retain(docs, keeps)
