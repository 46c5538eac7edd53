"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them, one vector kept per group.

Only vectors with equal labels are compared. Equal vectors are one node from the start,
with a multiplicity. A codebook of unit centroids is fitted on the driver on a bounded
sample (``SAMPLE`` nodes by hash; cells for the largest label's nodes, up to ``MOST_CELLS``) and every node goes to its
nearest centroid, its home cell. A node within the linking distance of the plane between
its home and a lower-numbered cell is a guest there too: two linked vectors of different
cells always meet in the lower one, so cells lose no link and the sample decides only
how much work is done.

Within a label's cell the home nodes stand in blocks, and so do all its nodes; every home
block is multiplied with every block, in a task's turn of bounded size, so a crowded cell
spreads over many turns. A turn returns link counts and a forest of links, not pairs. The
groups are the components of the forests.

A vector that is null, zero, or holds null or non-finite components, or has no label, links
with nothing: no links, its own component, kept. A component of rows without vec_id has a
null id. Repeated rows are vectors like others and link with each other. Empty input gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import runs
from millrace.llm.components import components
from millrace.session import materialize

COSINE = 0.98
SAMPLE, MOST_CELLS, NODES_PER_CELL = 16_384, 1024, 1024
BLOCK = 1024
#: Cosines this near the threshold are worked out again from the vectors as given.
DOUBT = 1e-9


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, width).astype(np.float64)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of unit points; an empty cell keeps its centroid."""
    centres = points[np.linspace(0, len(points) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([(points[a : a + 4096] @ centres.T).argmax(1) for a in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        size = np.linalg.norm(sums, axis=1)
        centres[size > 1e-9] = sums[size > 1e-9] / size[size > 1e-9, None]
    return centres


def cells_of(points: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point, cell, is home) for the home of every unit point and the cells it is a guest in."""
    near = points @ centres.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    reach = sqrt(1 - cosine * cosine) + 1e-9  # sine of the linking angle: how far a linked vector can lie behind a plane
    behind = near[np.arange(len(points)), home][:, None] - near
    guest = (behind <= reach * apart[home]) & (np.arange(len(centres)) < home[:, None])
    point, cell = np.nonzero(guest)
    at = np.arange(len(points))
    return np.r_[at, point], np.r_[home, cell], np.r_[np.ones(len(at), bool), np.zeros(len(point), bool)]


def forest(left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Of the links left[i] - right[i] among n nodes, a few that join the same components."""
    parent = np.arange(n)
    kept: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    while len(left):
        # the first link of every node, then only what still crosses components
        some = np.unique(np.r_[np.unique(left, return_index=True)[1], np.unique(right, return_index=True)[1]])
        for a, b in zip(left[some].tolist(), right[some].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[ra] = rb
                kept.append((a, b))
        roots = np.array([root(x) for x in range(n)])
        open_links = roots[left] != roots[right]
        left, right = left[open_links], right[open_links]
    return kept


def _turn(rows: pa.Table, cosine: float, width: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Nodes, the links counted for each (with the other's copies), and forest links, of one home block with one block."""
    node = rows["node"].to_numpy()
    copies = rows["copies"].to_numpy()
    first = rows["first"].to_numpy(zero_copy_only=False)
    home = rows["home"].to_numpy(zero_copy_only=False)
    given = matrix(rows["vector"], width)
    vectors = unit(given)
    a, b = np.flatnonzero(first), np.flatnonzero(~first)
    near = vectors[a] @ vectors[b].T
    linked = near >= cosine
    for i, j in zip(*np.nonzero(np.abs(near - cosine) < DOUBT)):
        x, y = given[a[i]], given[b[j]]
        linked[i, j] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine
    linked &= node[a][:, None] != node[b]
    counted = np.zeros(len(node), np.int64)
    counted[a] = linked @ copies[b]
    # two home nodes meet twice, each once on the left; a guest meets a home node once
    counted[b] = np.where(home[b], 0, copies[a] @ linked)
    i, j = np.nonzero(linked)
    return node, counted, forest(a[i], b[j], len(node))


def _nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows numbered, with the digest of their vector if it can link; and the distinct ones with their copies."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    length = F.aggregate(vec, F.lit(0.0), lambda s, v: s + v * v)
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.coalesce(length, F.lit(0.0)) > 0)
    digest = F.unhex(F.md5(F.concat_ws(",", F.col("label").cast("string"), F.array_join(vec.cast("array<string>"), ","))))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        F.when(fine, digest).alias("digest"),
        F.when(fine, F.col("label").cast("long")).alias("label"),
        F.when(fine, F.col("embedding")).alias("vector"),
    )
    rows = materialize(rows, "vectors")
    nodes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep"),
        F.first("label").alias("label"), F.first("vector").alias("vector"),
    )
    return rows, materialize(nodes, "vector-nodes")


def _link(nodes: DataFrame, width: int, cosine: float) -> DataFrame:
    """(node, other, links): counts in rows without ``other``, forest links in rows with it; for vectors of one width."""
    by_label = nodes.groupBy("label").count().agg(F.sum("count"), F.max("count")).first()
    count, most = by_label[0], by_label[1]
    share = min(1.0, SAMPLE / max(count, 1))
    picked = nodes.where(F.pmod(F.xxhash64("digest"), F.lit(1_000_003)) / 1_000_003.0 < share).select("digest", "vector")
    sample = sorted((bytes(r[0]), r[1]) for r in picked.collect())
    points = unit(np.array([v for _, v in sample], np.float64).reshape(-1, width))
    cells = max(1, min(MOST_CELLS, -(-most // NODES_PER_CELL), len(points)))
    centres = spherical_kmeans(points, cells) if len(points) else np.eye(1, width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                point, cell, home = cells_of(unit(matrix(part.column(3), width)), centres, cosine)
                made = part.take(pa.array(point))
                yield pa.RecordBatch.from_arrays(
                    [*made.columns, pa.array(cell, pa.int32()), pa.array(home, pa.bool_())],
                    names=["label", "node", "copies", "vector", "cell", "home"],
                )

    kind = nodes.schema["vector"].dataType.simpleString()
    schema = f"label long, node long, copies long, vector {kind}, cell int, home boolean"
    placed = materialize(nodes.select("label", "node", "copies", "vector").mapInArrow(assign, schema), "cells")
    sizes = placed.groupBy("label", "cell").agg(
        F.ceil(F.count_if("home") / BLOCK).cast("int").alias("home_blocks"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    )
    sizes = materialize(sizes, "cell-sizes")
    spot = F.xxhash64("node")
    mine, any_ = F.pmod(spot, F.col("home_blocks")).cast("int"), F.pmod(spot, F.col("blocks")).cast("int")
    as_first = F.when(
        F.col("home"),
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(mine.alias("i"), j.alias("j"), F.lit(True).alias("first"))),
    )
    as_second = F.transform(
        F.sequence(F.lit(0), F.col("home_blocks") - 1), lambda i: F.struct(i.alias("i"), any_.alias("j"), F.lit(False).alias("first"))
    )
    turns = F.concat(F.coalesce(as_first, F.array().cast("array<struct<i:int,j:int,first:boolean>>")), as_second)
    dealt = placed.join(sizes.where("home_blocks > 0"), ["label", "cell"])
    dealt = dealt.select("label", "cell", "node", "copies", "vector", "home", F.inline(turns))
    keys = ["label", "cell", "i", "j"]
    dealt = dealt.select(*keys, "node", "copies", "home", "first", "vector").repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 4):
            node, counted, joined = _turn(rows, cosine, width)
            some = np.flatnonzero(counted)
            ends = np.array(joined, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[node[some], node[ends[:, 0]]]),
                    pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[ends[:, 1]])]),
                    pa.array(np.r_[counted[some], np.zeros(len(ends), np.int64)]),
                ],
                names=["node", "other", "links"],
            )

    return dealt.mapInArrow(compare, "node long, other long, links long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows, nodes = _nodes(vectors)
    widths = [r[0] for r in nodes.select(F.size("vector").alias("width")).distinct().collect()]
    found = None
    for width in widths:
        part = _link(nodes.where(F.size("vector") == width), width, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = nodes.select("node", F.col("node").alias("other"), F.lit(0).cast("long").alias("links")).limit(0)
    found = materialize(found, "links")
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    joined = nodes.select("digest", "node", "copies", "rep").join(counts, "node", "left").join(rooted, "node", "left")
    joined = joined.withColumn("root", F.coalesce("root", "node"))
    least = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = joined.join(least, "root").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where("digest is not null").select("vec_id", "digest").join(materialize(known, "vector-groups"), "digest")
    out = out.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
