"""Nearest chunks per query over stored vectors, and the context block made from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import fixed

BROADCAST_BYTES = 64 * 1024 * 1024
QUERY_BLOCK = 2048
CHUNK_BLOCK = 8192
#: Rough distances held at a time (16 MiB), whatever the blocks' sizes; a few arrays of this size live at once.
ROUGH_CELLS = 1 << 21
#: Queries whose candidates are measured again at a time; each may have a whole block of ties.
TIE_ROWS = 16


def _top(queries: np.ndarray, query_ids: np.ndarray, chunks: np.ndarray, chunk_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest chunks of each query by (squared L2 distance, id).

    A matrix product gives distances up to rounding; everything within the
    rounding margin of the k-th is then measured again by differences, so equal
    vectors tie exactly and the order is that of the exact distances. Both are done
    for some queries at a time, which bounds the memory however large the blocks are and however many chunks tie.
    """
    k = min(k, len(chunk_ids))
    c2 = np.einsum("ij,ij->i", chunks, chunks)
    _, place_of_id = np.unique(chunk_ids, return_inverse=True)  # ids of any kind, by their order
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, ROUGH_CELLS // len(chunks))
    for begin in range(0, len(queries), step):
        some = queries[begin : begin + step]
        q2 = np.einsum("ij,ij->i", some, some)
        rough = some @ chunks.T
        rough *= -2.0
        rough += q2[:, None]
        rough += c2
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        near = rough <= (kth + 1e-9 * (1.0 + q2 + c2.max()))[:, None]
        for start in range(0, len(some), TIE_ROWS):
            rows, cols = np.nonzero(near[start : start + TIE_ROWS])
            rows += begin + start
            exact = np.square(queries[rows] - chunks[cols]).sum(axis=1)
            order = np.lexsort((place_of_id[cols], exact, rows))
            rows, cols, exact = rows[order], cols[order], exact[order]
            best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
            found.append((rows[best], cols[best], exact[best]))
    rows, cols, exact = (np.concatenate(x) for x in zip(*found))
    return pd.DataFrame({"query_id": query_ids[rows], "id": chunk_ids[cols], "distance": exact})


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _bytes(vectors: DataFrame) -> int:
    size = vectors.agg(F.coalesce(F.sum(F.size("embedding") * 8 + F.octet_length(F.col("id").cast("string")) + 16), F.lit(0)).alias("b"))
    return int(size.first()["b"])


def nearest(
    queries: DataFrame, chunks: DataFrame, k: int = 3, metric: str = "l2sq", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(query_id, rank, id, distance, score): exact search, best first, ties by id; ids are of any orderable type.

    Both sides have (id, embedding) and are measured. A side of up to ``broadcast_bytes``
    is sent to every task and the other is scanned where it lies: queries each
    against all chunks, or chunks keeping the best k of their part for each query.
    If both are larger, they are cut into blocks that meet block by block through a
    shuffle. A rank filter merges the candidates.
    """
    if metric not in ("l2sq", "l2"):
        raise ValueError(f"unknown metric: {metric}")
    kinds = {"query_id": queries.schema["id"].dataType, "id": chunks.schema["id"].dataType}
    schema = ", ".join(f"{n} {t.simpleString()}" for n, t in kinds.items()) + ", distance double"
    size = _bytes(chunks)
    if size == 0:
        hits = queries.sparkSession.createDataFrame([], schema)
    elif size <= broadcast_bytes:
        hits = _scan_queries(queries, chunks, k, schema)
    elif _bytes(queries) <= broadcast_bytes:
        hits = _scan_chunks(queries, chunks, k, schema)
    else:
        hits = _nearest_blocks(queries, chunks, k, schema)
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    distance = F.col("distance") if metric == "l2sq" else F.sqrt("distance")
    return ranked.select(
        "query_id", "rank", "id", distance.alias("distance"), (1.0 / (1.0 + distance)).alias("score")
    )


def _shared(vectors: DataFrame):
    """A side whose size the caller has checked, in every task."""
    local = vectors.select("id", "embedding").toPandas()
    matrix = _matrix(local["embedding"]) if len(local) else np.zeros((0, 0))
    return vectors.sparkSession.sparkContext.broadcast((matrix, local["id"].to_numpy()))


def _scan_queries(queries: DataFrame, chunks: DataFrame, k: int, schema: str) -> DataFrame:
    shared = _shared(chunks)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, ids = shared.value
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                part = batch.iloc[at : at + QUERY_BLOCK]
                q, qid = _matrix(part["embedding"]), part["id"].to_numpy()
                for c in range(0, len(ids), CHUNK_BLOCK):
                    yield _top(q, qid, vectors[c : c + CHUNK_BLOCK], ids[c : c + CHUNK_BLOCK], k)

    return queries.select("id", "embedding").mapInPandas(scan, schema)


def _scan_chunks(queries: DataFrame, chunks: DataFrame, k: int, schema: str) -> DataFrame:
    shared = _shared(queries)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, ids = shared.value
        best: pd.DataFrame | None = None
        for batch in batches:
            for at in range(0, len(batch) if len(ids) else 0, CHUNK_BLOCK):
                part = batch.iloc[at : at + CHUNK_BLOCK]
                c, cid = _matrix(part["embedding"]), part["id"].to_numpy()
                hits = [_top(vectors[q : q + QUERY_BLOCK], ids[q : q + QUERY_BLOCK], c, cid, k) for q in range(0, len(ids), QUERY_BLOCK)]
                merged = pd.concat([*hits] if best is None else [best, *hits]).sort_values(["query_id", "distance", "id"])
                best = merged.groupby("query_id", sort=False).head(k)
        if best is not None:
            yield best

    return chunks.select("id", "embedding").mapInPandas(scan, schema)


def _nearest_blocks(queries: DataFrame, chunks: DataFrame, k: int, schema: str) -> DataFrame:
    """Block product: every query block meets every chunk block in a task of its own.

    The number of blocks comes from the row counts, so both sides of a cell have a
    bounded size whatever the tables hold.
    """
    n_q = max(1, -(-queries.count() // QUERY_BLOCK))
    n_c = max(1, -(-chunks.count() // CHUNK_BLOCK))
    q = queries.select(
        "id", "embedding", F.pmod(F.xxhash64("id"), F.lit(n_q)).alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))).alias("cb"),
    )
    c = chunks.select(
        "id", "embedding",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))).alias("qb"), F.pmod(F.xxhash64("id"), F.lit(n_c)).alias("cb"),
    )

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "id": [], "distance": []})
        return _top(
            _matrix(left["embedding"]), left["id"].to_numpy(), _matrix(right["embedding"]), right["id"].to_numpy(), k
        )

    return q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(cell, schema)


def context_blocks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """(query_id, context): header and numbered texts in rank order, from ranked hits and (id, text)."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "text"))),
        lambda h, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), h["text"]),
    )
    joined = hits.select("query_id", "rank", "id").join(chunks.select("id", "text"), "id")
    return joined.groupBy("query_id").agg(
        F.concat_ws("\n", F.lit(fixed.CONTEXT_HEADER), F.array_join(lines, "\n")).alias("context")
    )


def with_context(prompts: DataFrame, blocks: DataFrame) -> DataFrame:
    """Attach ``context`` to prompts (query_id, ...); no hit gives an empty one."""
    return prompts.join(blocks, "query_id", "left").withColumn("context", F.coalesce("context", F.lit("")))


def context_found(queries: DataFrame, hits: DataFrame, min_score: float | None = None) -> DataFrame:
    """(query_id, found): whether any hit, optionally of at least ``min_score``, exists."""
    good: Column = F.col("rank") == 1
    if min_score is not None:
        good = good & (F.col("score") >= min_score)
    found = hits.where(good).select("query_id", F.lit(True).alias("found"))
    return queries.select(F.col("id").alias("query_id")).join(found, "query_id", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def unknown_topic_rate(found: DataFrame) -> DataFrame:
    """One row: hit and empty retrievals and the share of empty ones."""
    return found.agg(
        F.count_if("found").alias("hit"),
        F.count_if(~F.col("found")).alias("empty"),
        F.coalesce(F.avg(F.when(F.col("found"), 0.0).otherwise(1.0)), F.lit(0.0)).alias("unknown_topic_rate"),
    )
