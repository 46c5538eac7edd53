"""Approximate nearest chunks: an index of cells around centroids, of which a query looks into a few.

The centroids, and how many cells a query has to look into, are fitted on a bounded sample (SAMPLE vectors by
hash order): the smallest number of cells that finds the wanted share of the sample's own neighbours. Every
vector is then indexed, in the cell of its nearest centroid, and stored sorted by cell, so that a scan for a few
cells skips the others' row groups; a cell that holds a large part of all vectors lies in many files.
Distances of the candidates are exact, so an approximate result differs from the exact one only by chunks in cells
that were not looked into.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.retrieval import BROADCAST_BYTES, CHUNK_BLOCK, QUERY_BLOCK, _bytes, _matrix, _top
from millrace.session import materialize

#: Vectors the centroids are fitted on, at most.
SAMPLE = 16_384
#: Cells at most, whatever the table holds: the centroids travel with every task.
MOST_CELLS = 1_024
ROUNDS = 12
#: Sample vectors that are searched to choose the number of cells to look into.
TRIED = 256


@dataclass(frozen=True)
class Cells:
    centroids: np.ndarray
    probes: int


def nearest_cells(points: np.ndarray, centroids: np.ndarray, n: int = 1) -> np.ndarray:
    """Numbers of the ``n`` nearest centroids of each point, nearest first, equal ones by number."""
    far = np.einsum("ij,ij->i", centroids, centroids)[None, :] - 2.0 * points @ centroids.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def _centroids(points: np.ndarray, cells: int) -> np.ndarray:
    """Lloyd's rounds from the first different points; a cell that loses all its points takes the one worst placed."""
    centres = np.unique(points, axis=0)
    centres = centres[np.random.default_rng(0).permutation(len(centres))[:cells]]
    for _ in range(ROUNDS):
        own = nearest_cells(points, centres)[:, 0]
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        worst = iter(np.argsort(-np.square(points - centres[own]).sum(axis=1), kind="stable"))
        centres = np.array([s / c if c else points[next(worst)] for s, c in zip(sums, counts)])
    return centres


def _probes(points: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """The fewest cells in which the first points find the wanted share of their k nearest other points."""
    own = nearest_cells(points, centres)[:, 0]
    asked = points[:TRIED]
    far = np.square(asked).sum(1)[:, None] + np.square(points).sum(1)[None, :] - 2.0 * asked @ points.T
    far[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argsort(far, axis=1, kind="stable")[:, : min(k, len(points) - 1)]
    order = nearest_cells(asked, centres, len(centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :], axis=1)
    needed = np.take_along_axis(place, own[near], axis=1) + 1  # cells until each neighbour is met
    return int(np.quantile(needed, recall, method="inverted_cdf")) if needed.size else 1


def fit(vectors: DataFrame, k: int = 3, recall: float = 0.97, cells: int | None = None) -> Cells:
    """Cells for a table of (id, embedding): about the root of the sample's size of them, or ``cells``."""
    place = F.xxhash64("id", F.lit("cells"))
    rows = vectors.where(F.col("embedding").isNotNull()).select("embedding", place.alias("p"), "id").orderBy("p", "id").limit(SAMPLE)
    found = rows.select("embedding").toPandas()["embedding"]
    if not len(found):
        return Cells(np.zeros((0, 0)), 1)
    points = _matrix(found)
    centres = _centroids(points, min(cells or max(1, int(len(points) ** 0.5)), MOST_CELLS))
    return Cells(centres, _probes(points, centres, k, recall))


def build(vectors: DataFrame, cells: Cells) -> DataFrame:
    """The index: (cell, id, embedding) of every vector, written once, sorted by cell. Null vectors aren't chunks."""
    kind = vectors.schema["id"].dataType.simpleString()
    held = vectors.sparkSession.sparkContext.broadcast(cells.centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK_BLOCK):
                part = batch.iloc[at : at + CHUNK_BLOCK]
                own = nearest_cells(_matrix(part["embedding"]), held.value)[:, 0]
                yield pd.DataFrame({"cell": own, "id": part["id"].to_numpy(), "embedding": part["embedding"].to_numpy()})

    rows = vectors.where(F.col("embedding").isNotNull()).select("id", "embedding")
    shape = vectors.schema["embedding"].dataType.simpleString()
    placed = rows.mapInPandas(assign, f"cell int, id {kind}, embedding {shape}")
    spread = placed.repartitionByRange("cell", F.xxhash64("id")).sortWithinPartitions("cell")
    return materialize(spread, "vector-cells")


def search(queries: DataFrame, index: DataFrame, cells: Cells, k: int = 3, probes: int | None = None, block_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest of the chunks in each query's nearest cells, by squared distance, then id.

    Queries are measured and go to the tasks in blocks of about ``block_bytes``; a task keeps the best k of its part
    for each query of the block. A query in cells with fewer than k chunks gets fewer.
    """
    asked = queries.where(F.col("embedding").isNotNull()).select("id", "embedding")
    kinds = {"query_id": queries.schema["id"].dataType, "id": index.schema["id"].dataType}
    schema = ", ".join(f"{n} {t.simpleString()}" for n, t in kinds.items()) + ", distance double"
    n = max(1, -(-_bytes(asked) // block_bytes)) if len(cells.centroids) else 0
    hits = queries.sparkSession.createDataFrame([], schema)
    for block in range(n):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(n)) == block) if n > 1 else asked
        hits = hits.unionByName(_search_block(mine, index, cells, k, probes or cells.probes, schema))
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def _search_block(queries: DataFrame, index: DataFrame, cells: Cells, k: int, probes: int, schema: str) -> DataFrame:
    local = queries.toPandas()
    if not len(local):
        return queries.sparkSession.createDataFrame([], schema)
    matrix, ids = _matrix(local["embedding"]), local["id"].to_numpy()
    probed = np.concatenate([nearest_cells(matrix[at : at + QUERY_BLOCK], cells.centroids, probes) for at in range(0, len(matrix), QUERY_BLOCK)])
    held = queries.sparkSession.sparkContext.broadcast((matrix, ids, probed))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, names, looks = held.value
        best: pd.DataFrame | None = None
        for batch in batches:
            for cell, rows in batch.groupby("cell", sort=False):
                asks = np.flatnonzero((looks == cell).any(axis=1))
                hits = []
                for at in range(0, len(rows) if len(asks) else 0, CHUNK_BLOCK):
                    part = rows.iloc[at : at + CHUNK_BLOCK]
                    c, cid = _matrix(part["embedding"]), part["id"].to_numpy()
                    for q in range(0, len(asks), QUERY_BLOCK):
                        who = asks[q : q + QUERY_BLOCK]
                        hits.append(_top(vectors[who], names[who], c, cid, k))
                if hits:
                    merged = pd.concat([*hits] if best is None else [best, *hits]).sort_values(["query_id", "distance", "id"])
                    best = merged.groupby("query_id", sort=False).head(k)
        if best is not None:
            yield best

    wanted = [int(c) for c in np.unique(probed)]
    return index.where(F.col("cell").isin(wanted)).mapInPandas(scan, schema)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: neighbours of the exact search, those the other search found, and their share."""
    truth = exact.select("query_id", "id")
    met = truth.join(found.select("query_id", "id"), ["query_id", "id"], "left_semi")
    counts = truth.agg(F.count(F.lit(1)).alias("exact")).withColumn("_k", F.lit(1))
    return counts.join(met.agg(F.count(F.lit(1)).alias("found")).withColumn("_k", F.lit(1)), "_k").select(
        "exact", "found", F.try_divide(F.col("found"), F.col("exact")).alias("recall")
    )
