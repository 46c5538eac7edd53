"""BPE encoding and decoding of a text column (see ``bpe.py`` for the method).

Row by row: no shuffle, no state beyond a bounded table of words per task. Whole
texts, handled in slices of neighbouring rows, so memory follows the longest text.

Null text counts as empty: no ids, and an empty decoded text. Repeated rows give
repeated results; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import load
from millrace.llm.common import slices, texts_of


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key``, ``ids`` (little-endian unsigned 32-bit ids) and, if wished, the text ``decoded`` from the ids."""
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            raw = texts_of(batch.column(1))
            for a, b in slices([len(x) for x in raw]):
                flat, counts = bpe.encode([x.decode() for x in raw[a:b]])
                ends = np.cumsum(counts)
                parts = [flat[e - n : e] for e, n in zip(ends, counts)]
                out = [batch.column(0).slice(a, b - a), pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())]
                if decoded:
                    out.append(pa.array([bpe.decode(p) for p in parts], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["key", "ids", "decoded"][: len(out)])

    more = ", decoded string" if decoded else ""
    return rows.mapInArrow(run, f"key {kind}, ids binary{more}").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the text ``decoded`` from packed ids; null ids give the empty text."""
    rows = encoded.select(F.col(key), F.col(ids).alias("ids"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            raw = texts_of(batch.column(1))
            for a, b in slices([len(x) for x in raw]):
                made = [bpe.decode(np.frombuffer(x, "<u4")) for x in raw[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(made, pa.string())], names=["key", "decoded"]
                )

    return rows.mapInArrow(run, f"key {kind}, decoded string").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Count and SHA-256 of the ids, SHA-256 of the decoded text."""
    return encoded.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
