"""Best-fit packing of documents into sequences by vector best fit.

Every sequence has three capacities: tokens, documents, and attention cost (the sum of
squared lengths). Pieces are placed by decreasing length; a piece goes to the open
sequence that can hold it under every capacity and is best by the chosen rule: the
smallest weighted norm of what is left (``norm``) or the largest weighted dot product
of what is left with what is asked (``dot``). All open sequences of a group are weighed.

Only lengths travel: texts are encoded where they are read, the pieces are written as a
narrow table, dealt evenly into groups of about ``group`` pieces and each group is packed
by itself. Pieces are dealt round robin, so no key or source makes a group large. A
group leaves about one sequence partly filled.

Null text is empty and gives one piece, the end id alone. Repeated rows are packed each.
An empty input gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import Bpe, load
from millrace.llm.common import texts_of
from millrace.session import materialize


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most; the defaults of the last two never bind."""

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


_FAST: dict[str, tuple[tiktoken.Encoding, Bpe]] = {}


def _encoder(path: str) -> tuple[tiktoken.Encoding, Bpe]:
    """The file's byte-level vocabulary in a second library, several times faster with the same ids; and its own form."""
    if path not in _FAST:
        bpe = load(path)
        ranks = {bpe.pieces[i]: i for i in range(len(bpe.pieces)) if bpe.names[i] not in bpe.special}
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        made = tiktoken.Encoding(path, pat_str=split, mergeable_ranks=ranks, special_tokens=bpe.special)
        _FAST[path] = made, bpe
    return _FAST[path]


def token_ids(path: str, text: str) -> np.ndarray:
    """Ids of a text; special tokens in it are recognised. Texts with very long runs of white space take the slower way."""
    fast, slow = _encoder(path)
    if "     " * 200 in text or "\n" * 1000 in text:
        return slow.encode([text])[0].astype("<u4")
    return np.array(fast.encode(text, allowed_special="all"), "<u4")


def pieces(docs: DataFrame, path: str, longest: int = 2048, end_id: int = 0) -> DataFrame:
    """Documents as pieces of at most ``longest`` ids: doc_id, piece, start, length, ids_crc32.

    A document is its ids and ``end_id``. Only longer ones are cut; then the first piece
    takes the remainder and all others are full.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, raw in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                ids = np.append(token_ids(path, raw.decode()), np.uint32(end_id)).astype("<u4")
                cuts = [0, *range(len(ids) % longest or longest, len(ids), longest), len(ids)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for column, value in zip(out, (key, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """The sequence of every piece, by vector best fit decreasing."""
    full = np.array([capacity.tokens, capacity.documents, capacity.cost], float)
    weights = np.array(capacity.weights)
    order = np.argsort(-lengths, kind="stable")
    chosen = np.empty(len(lengths), np.int64)
    left = np.empty((3, 1024))
    names = np.empty(1024, np.int64)
    n_open = n_made = 0
    least = int(lengths.min()) if len(lengths) else 0
    for i in order:
        ask = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        if (ask > full).any():
            raise ValueError("a piece is larger than a sequence may be")
        room = left[:, :n_open]
        fits = np.flatnonzero((room >= ask[:, None]).all(0))
        if len(fits):
            rest = room[:, fits]
            if capacity.rule == "dot":
                score = -(weights * ask / full**2) @ rest
            else:
                score = weights @ ((rest - ask[:, None]) / full[:, None]) ** 2
            at = fits[np.argmin(score)]
        else:
            if n_open == left.shape[1]:
                left = np.concatenate([left, np.empty_like(left)], axis=1)
                names = np.concatenate([names, np.empty_like(names)])
            at = n_open
            left[:, at], names[at] = full, n_made
            n_open, n_made = n_open + 1, n_made + 1
        left[:, at] -= ask
        chosen[i] = names[at]
        if left[0, at] < least or left[1, at] < 1 or left[2, at] < 1:  # nothing fits any more
            n_open -= 1
            left[:, at], names[at] = left[:, n_open], names[n_open]
    return chosen


def pack(parts: DataFrame, capacity: Capacity | None = None, group: int = 16_384) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``parts`` is a written table of :func:`pieces`."""
    capacity = capacity or Capacity()
    groups = max(1, -(-parts.count() // group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        lengths = rows["length"].to_numpy()
        own = fit(lengths, capacity)
        order = np.argsort(own, kind="stable")
        ends = np.cumsum(lengths[order])
        before = ends - lengths[order]
        heads = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0])
        offset = np.empty(len(own), np.int64)
        offset[order] = before - np.repeat(before[heads], np.diff(np.r_[heads, len(own)]))
        base = TaskContext.get().partitionId() << 32
        rows = rows.append_column("sequence_id", pa.array(own + base)).append_column("offset", pa.array(offset))
        yield from rows.to_batches(max_chunksize=10_000)

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return parts.repartition(groups).mapInArrow(run, kinds)


def pack_documents(docs: DataFrame, path: str, capacity: Capacity | None = None) -> DataFrame:
    """Encode, cut and pack: one row per piece."""
    capacity = capacity or Capacity()
    return pack(materialize(pieces(docs, path, capacity.tokens), "pieces"), capacity)
