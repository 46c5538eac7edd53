"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Lower-cases A-Z in UTF-8 bytes and nothing else.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Python handles texts in pieces of about this many bytes, whatever the size of an Arrow batch.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(lengths: list[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose lengths sum to about ``most``; a longer one stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def retain(docs: DataFrame, keeps: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows, with all their columns, whose text ``keeps`` accepts."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(at))
            for a, b in slices([len(t) for t in texts]):
                kept = batch.slice(a, b - a).filter(pa.array(keeps(texts[a:b]), pa.bool_()))
                if kept.num_rows:
                    yield kept

    return docs.mapInArrow(run, docs.schema)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows that follow each other with equal whole-number values in the first ``keys`` columns, as one table each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        changed = np.any([np.diff(c) != 0 for c in columns], axis=0)
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and any(held[0].column(i)[0].as_py() != c[a].item() for i, c in enumerate(columns)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
