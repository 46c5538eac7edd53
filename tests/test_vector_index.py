"""The approximate vector index: every row indexed, candidates exact, recall measured."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import retrieval, vector_index


def frame(spark, points, first=0, kind="long"):
    rows = [(i + first if kind == "long" else f"v{i + first:05d}", p.tolist(), "x", 0) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, f"id {kind}, embedding array<float>, distance string, cell int")


def clustered(n, spread=0.15, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, 16))
    return centres[rng.integers(0, 40, n)] + rng.normal(size=(n, 16)) * spread


@pytest.fixture(scope="module")
def made(spark):
    points = np.concatenate([clustered(3000), np.repeat(clustered(1, seed=2), 1500, axis=0)])  # a third are copies of one vector
    chunks = frame(spark, points).repartition(6)
    cells = vector_index.fit(chunks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        return chunks, cells, vector_index.build(chunks, cells)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_every_vector_is_in_its_nearest_cell(made):
    chunks, cells, index = made
    rows = index.collect()
    assert sorted(r.id for r in rows) == list(range(4500))
    own = vector_index.nearest_cells(np.array([r.embedding for r in rows], float), cells.centroids)[:, 0]
    assert [r.cell for r in rows] == own.tolist()
    assert len(index.inputFiles()) > 1


@pytest.mark.parametrize("block_bytes", [retrieval.BROADCAST_BYTES, 4_000])
def test_recall_of_stated_queries_against_all_rows(made, block_bytes):
    chunks, cells, index = made
    assert cells.probes < len(cells.centroids) / 2  # otherwise nothing is saved
    asked = chunks.where("id % 50 = 0")
    exact = retrieval.nearest(asked, chunks).persist()
    found = vector_index.search(asked, index, cells, block_bytes=block_bytes)
    told = vector_index.recall(found, exact).first()
    assert told.exact == 3 * 90 and told.recall >= 0.9
    # what is found has its exact distance
    far = {(r.query_id, r.id): r.distance for r in exact.collect()}
    near = [r for r in found.collect() if (r.query_id, r.id) in far]
    assert all(r.distance == far[r.query_id, r.id] for r in near)
    exact.unpersist()


def test_all_cells_give_the_exact_search(made):
    chunks, cells, index = made
    asked = chunks.where("id % 97 = 0")
    found = vector_index.search(asked, index, cells, k=5, probes=len(cells.centroids))
    cols = ["query_id", "rank", "id", "distance"]
    assert sorted(map(tuple, found.select(cols).collect())) == sorted(map(tuple, retrieval.nearest(asked, chunks, 5).select(cols).collect()))


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    cells = vector_index.fit(vectors)
    asked = vectors.where("id % 50 = 0")
    found = vector_index.search(asked, vector_index.build(vectors, cells), cells)
    assert vector_index.recall(found, retrieval.nearest(asked, vectors)).first().recall >= 0.9


def test_text_ids_null_vectors_and_empty_tables(spark):
    chunks = frame(spark, clustered(200), kind="string").union(
        spark.createDataFrame([("none", None, "x", 0)], "id string, embedding array<float>, distance string, cell int")
    )
    cells = vector_index.fit(chunks, cells=7)
    index = vector_index.build(chunks, cells)
    assert index.count() == 200 and len(cells.centroids) == 7
    asked = chunks.where("id < 'v00010' OR id = 'none'")
    found = vector_index.search(asked, index, cells, k=1).collect()
    assert {r.query_id: r.id for r in found} == {f"v{i:05d}": f"v{i:05d}" for i in range(10)}
    nothing = vector_index.fit(chunks.limit(0))
    assert vector_index.search(asked, index.limit(0), nothing).count() == 0
    assert vector_index.search(asked.limit(0), index, cells).count() == 0
    one = frame(spark, np.ones((3, 4)))
    cells = vector_index.fit(one)
    assert [r.id for r in vector_index.search(one.where("id = 1"), vector_index.build(one, cells), cells, 2).orderBy("rank").collect()] == [0, 1]
