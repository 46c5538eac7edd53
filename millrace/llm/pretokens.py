"""Byte-level BPE in two tiers: whole pre-tokens by perfect hash, the others by a heap over linked bytes.

Most pre-tokens of a text are entries of the vocabulary. They are looked up many at a time in a
minimal perfect hash of the vocabulary: one displacement per bucket of keys sends the n entries to the
places 0 to n - 1, so a look-up is two array reads and a comparison with the bytes stored there, which
tells strangers. What isn't in the vocabulary starts as a linked list of bytes; a heap gives the
neighbours of lowest rank, from the left where ranks are equal, until no neighbours form an entry.

Row by row: no shuffle, and no state beyond a table of seen pre-tokens of bounded size per task. Texts
are handled whole, their pre-tokens in chunks, so memory follows the ids of the longest text; a long
pre-token costs about its length times the logarithm of it.

Null text counts as empty: no ids and no bytes. Repeated rows give repeated results. Strings of special
tokens are ordinary text. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ranges, slices, texts_of

#: Most pre-tokens a task remembers; beyond that the table starts anew.
REMEMBERED = 600_000
#: Pre-tokens of a text that are handled at a time.
CHUNK_WORDS = 1 << 18
#: Keys in a bucket of the perfect hash, on average.
PER_BUCKET = 2
#: Displacements tried at a time.
TRIED = 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX[0]
    x = (x ^ x >> np.uint64(27)) * _MIX[1]
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """Place of each of n distinct byte strings in 0 to n - 1; strangers are told by comparison."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.longest = n, max(map(len, keys), default=0)
        self.powers = np.cumprod(np.full(self.longest + 1, _MULTIPLIER), dtype=np.uint64)
        self.buckets = max(1, n // PER_BUCKET)
        sizes = np.array([len(k) for k in keys], np.int64)
        data = np.frombuffer(b"".join(keys), np.uint8)
        hashes = self._hash(data, np.cumsum(sizes) - sizes, sizes)
        if len(np.unique(hashes)) < n:
            raise ValueError("keys repeat or their hashes collide")
        place = self._displace(hashes)
        order = np.argsort(place)
        self.key = order  # number of the key at each place
        self.sizes = sizes[order]
        self.starts = (np.cumsum(sizes) - sizes)[order]
        self.data = data

    def _hash(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        at = ranges(starts, sizes)
        behind = np.repeat(starts + sizes, sizes) - 1 - at
        parts = (data[at].astype(np.uint64) + np.uint64(1)) * self.powers[behind]
        return _mixed(np.add.reduceat(parts, np.cumsum(sizes) - sizes) if len(sizes) else np.empty(0, np.uint64))

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)) % np.uint64(self.buckets)

    def _displace(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the keys, large buckets first; a bucket of one key is sent straight to a free place."""
        self.shift = np.zeros(self.buckets, np.int64)
        n, place, taken = np.uint64(max(1, self.n)), np.empty(self.n, np.int64), np.zeros(self.n, bool)
        bucket = self._bucket(hashes)
        order = np.argsort(bucket, kind="stable")
        heads = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if self.n else []
        groups = sorted(np.split(order, heads[1:]) if self.n else [], key=len, reverse=True)
        single = [g[0] for g in groups if len(g) == 1]
        for group in groups[: len(groups) - len(single)]:
            own, tried = hashes[group], 0
            while True:
                shifts = np.arange(tried, tried + TRIED, dtype=np.uint64)
                at = _mixed(own + shifts[:, None] * _MULTIPLIER) % n
                free = np.flatnonzero(~taken[at].any(axis=1))
                found = next((k for k in free.tolist() if len(set(at[k].tolist())) == len(group)), None)
                if found is not None:
                    break
                tried += TRIED
            place[group] = at[found]
            taken[at[found]] = True
            self.shift[bucket[group[0]]] = tried + found
        for key, free in zip(single, np.flatnonzero(~taken)):
            place[key] = free
            self.shift[bucket[key]] = -1 - free
        return place

    def find(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of the key that equals each span, -1 for a stranger; spans are not empty."""
        found = np.full(len(starts), -1, np.int64)
        fit = np.flatnonzero(sizes <= self.longest)
        if not len(fit) or not self.n:
            return found
        starts, sizes = starts[fit], sizes[fit]
        hashes = self._hash(data, starts, sizes)
        shift = self.shift[self._bucket(hashes)]
        moved = _mixed(hashes + shift.astype(np.uint64) * _MULTIPLIER) % np.uint64(self.n)
        place = np.where(shift < 0, -1 - shift, moved.astype(np.int64))
        alike = np.flatnonzero(self.sizes[place] == sizes)
        if len(alike):
            n = sizes[alike]
            differ = data[ranges(starts[alike], n)] != self.data[ranges(self.starts[place[alike]], n)]
            same = alike[~np.logical_or.reduceat(differ, np.cumsum(n) - n)]
            found[fit[same]] = self.key[place[same]]
        return found


class Encoder:
    """The vocabulary of a rank file with the pattern that cuts texts into pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        keys = list(self.ranks)
        self.ids = np.fromiter(self.ranks.values(), np.int64, len(keys))
        self.hash = PerfectHash(keys)
        self.pieces = np.full(int(self.ids.max()) + 1, b"", object)
        self.pieces[self.ids] = keys
        # White space by its Unicode property; the module's own class holds four separators more.
        self.split = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        #: Rank of two bytes, by their number; -1 if they are no entry.
        self.first = [-1] * (1 << 16)
        for key in keys:
            if len(key) == 2:
                self.first[key[0] << 8 | key[1]] = self.ranks[key]
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """Ids of bytes that aren't an entry as a whole."""
        rank_of, longest, n, first = self.ranks.get, self.hash.longest, len(raw), self.first
        after = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n))  # where the part before the one that starts here starts
        wanted = [first[a << 8 | b] for a, b in zip(raw, raw[1:])]  # rank of the pair that starts here
        wanted.append(-1)
        bits = n.bit_length()
        places = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(wanted) if r >= 0]  # rank first, then place
        heapify(heap)
        while heap:
            least = heappop(heap)
            start = least & places
            if wanted[start] != least >> bits:
                continue
            middle = after[start]
            end = after[start] = after[middle]
            wanted[start] = wanted[middle] = -1
            if end < n:
                before[end] = start
                if (stop := after[end]) - start <= longest:
                    new = wanted[start] = rank_of(raw[start:stop], -1)
                    if new >= 0:
                        heappush(heap, new << bits | start)
            if start:
                left = before[start]
                new = wanted[left] = rank_of(raw[left:end], -1) if end - left <= longest else -1
                if new >= 0:
                    heappush(heap, new << bits | left)
        out, at = [], 0
        while at < n:
            out.append(self.ranks[raw[at : after[at]]])
            at = after[at]
        return tuple(out)

    def learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        sizes = np.array([len(w) for w in raw], np.int64)
        found = self.hash.find(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes)
        ids = np.where(found >= 0, self.ids[found], -1).tolist()
        self.known.update((w, (i,) if i >= 0 else self.merge(b)) for w, b, i in zip(words, raw, ids))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; the pre-tokens of many short texts, or a part of those of a long one, are handled together."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        counts: list[tuple[int, int]] = []  # text and how many of the words are its own
        for number, text in enumerate(texts):
            matches = self.split.finditer(text)
            while found := [m[0] for m in islice(matches, CHUNK_WORDS - len(words))]:
                words += found
                counts.append((number, len(found)))
                if len(words) == CHUNK_WORDS:
                    self._flush(words, counts, parts)
        self._flush(words, counts, parts)
        return [np.concatenate([np.empty(0, np.int32), *p]) if len(p) != 1 else p[0] for p in parts]

    def _flush(self, words: list[str], counts: list[tuple[int, int]], parts: list[list[np.ndarray]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = [w for w in set(words) if w not in self.known]
        if fresh:
            self.learn(fresh)
        given = iter(words)
        for number, n in counts:
            ids = chain.from_iterable(map(self.known.__getitem__, islice(given, n)))
            parts[number].append(np.fromiter(ids, np.int32))
        words.clear()
        counts.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.pieces[ids].tolist())


_LOADED: dict[tuple[str, str], Encoder] = {}


def load(path: str, pattern: str) -> Encoder:
    """The encoder of a file, built once in each Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Encoder(path, pattern)
    return _LOADED[path, pattern]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *parts])))


def encode(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """``key``, ``ids`` (array of int) and, if wished, the bytes ``decoded`` from the ids."""
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            raw = texts_of(batch.column(1))
            for a, b in slices([len(x) for x in raw]):
                parts = coder.encode([x.decode() for x in raw[a:b]])
                out = [batch.column(0).slice(a, b - a), _lists(parts)]
                if decoded:
                    out.append(pa.array([coder.decode(p) for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=["key", "ids", "decoded"][: len(out)])

    more = ", decoded binary" if decoded else ""
    return rows.mapInArrow(run, f"key {kind}, ids array<int>{more}").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the bytes ``decoded`` from ids; null ids give no bytes."""
    rows = encoded.select(F.col(key), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            lists = batch.column(1)
            values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            made = [coder.decode(values[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["key", "decoded"])

    return rows.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Count and SHA-256 of the ids as decimal numbers joined by commas, SHA-256 of the decoded bytes."""
    return encoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
