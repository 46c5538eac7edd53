"""Shards of near-equal bytes by Karmarkar-Karp differencing; groups of equal texts stay whole.

A partial partition is one total per shard with what is behind it. Two of them are
combined by adding the largest total of one to the smallest of the other, and so on; the
two with the largest spread go first, until one is left. This runs on two levels: the
groups of a bucket (dealt by hash) are differenced in a task into as many parcels as
there are shards, and the parcels of all buckets are differenced on the driver into the
shards. A bucket stands for up to ``BUCKET_ROWS`` rows. With more than ``LEVEL`` buckets their
parcels are buckets' rows again, differenced in tasks level by level, until at most ``LEVEL``
are left; the driver sees at most ``LEVEL`` x shards numbers whatever the table's size.

A group that is larger than a shard's share is a parcel, and then a shard, of its own;
no law on bytes can cut it.

Each text is read once, for its size, checksum and digest; all that follows runs on a
narrow table. Slots are counted by (shard, part) and numbered within, a part holding a
bounded share of a shard, so that neither a group nor a shard is sorted in one task.

Null text counts as empty (8 bytes, checksum 0). Rows with a null or repeated doc_id are
rows like others and get slots of their own. Empty input gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.session import materialize

SHARDS, BUCKETS, PARTS = 24, 256, 4096
#: Rows for which a bucket is made at least, so that a task's heap stays small.
BUCKET_ROWS = 200_000
BROADCAST_PARCELS = 200_000
#: Most buckets whose parcels are differenced together in a task, and in the end on the driver.
LEVEL = 256


def difference(parts: list[tuple[list[int], list[object]]]) -> tuple[list[int], list[object]]:
    """Karmarkar-Karp over partial partitions, each with ascending totals and the contents behind each total.

    Contents are pairs (left, right), None for nothing, or a leaf. Returns the last partition.
    """
    heap = [(totals[0] - totals[-1], i, totals, held) for i, (totals, held) in enumerate(parts)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, first, own = heapq.heappop(heap)
        _, _, second, other = heapq.heappop(heap)
        merged = [
            (a + b, i, x if y is None else y if x is None else (x, y))
            for i, (a, b, x, y) in enumerate(zip(first, reversed(second), own, reversed(other)))
        ]
        merged.sort(key=lambda m: m[:2])
        totals = [m[0] for m in merged]
        heapq.heappush(heap, (totals[0] - totals[-1], number, totals, [m[2] for m in merged]))
        number += 1
    return heap[0][2], heap[0][3]


def leaves(held: object) -> Iterator[int]:
    """The leaves behind a total; they are whole numbers."""
    stack = [held]
    while stack:
        at = stack.pop()
        if isinstance(at, tuple):
            stack.extend(at)
        elif at is not None:
            yield at


def split(sizes: list[int], ways: int) -> tuple[list[int], np.ndarray]:
    """Totals in ascending order, and the place of every item's total in that order."""
    place = np.zeros(len(sizes), np.int64)
    if not sizes:
        return [0] * ways, place
    start = [([0] * (ways - 1) + [n], [None] * (ways - 1) + [i]) for i, n in enumerate(sizes)]
    totals, held = difference(start)
    for at, content in enumerate(held):
        place[list(leaves(content))] = at
    return totals, place


def _bucket_places(groups: DataFrame, ways: int) -> DataFrame:
    """bucket, the second column (an item), bytes and place; a task holds whole buckets, one after the other."""
    item = groups.schema[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            held.clear()
            _, place = split(rows["bytes"].to_pylist(), ways)
            return rows.append_column("place", pa.array(place, pa.int32())).combine_chunks().to_batches()[0]

        for batch in batches:
            own = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if held and held[0].column(0)[0].as_py() != own[a]:
                    yield close()
                held.append(batch.slice(a, b - a))
        if held:
            yield close()

    sorted_groups = groups.repartition("bucket").sortWithinPartitions("bucket", F.desc("bytes"), item.name)
    return sorted_groups.mapInArrow(run, f"bucket int, {item.name} {item.dataType.simpleString()}, bytes long, place int")


def _shard_of_places(placed: DataFrame, ways: int, buckets: int, level: int) -> DataFrame:
    """bucket, place and shard, by differencing the parcels of ``level`` buckets at a time until the driver can do the rest."""
    totals = placed.groupBy("bucket", "place").agg(F.sum("bytes").alias("bytes"))
    below: list[DataFrame] = []
    while buckets > level:
        item = (F.col("bucket").cast("long") * ways + F.col("place")).alias("item")
        parcels = totals.select(F.expr(f"bucket div {level}").cast("int").alias("bucket"), item, "bytes")
        below.append(materialize(_bucket_places(parcels, ways), "parcels"))
        totals = below[-1].groupBy("bucket", "place").agg(F.sum("bytes").alias("bytes"))
        buckets = -(-buckets // level)
    parcels = sorted((r["bucket"], r["place"], r["bytes"]) for r in totals.collect())
    _, shard_of = split([n for _, _, n in parcels], ways)
    found = [(bucket, place, int(shard)) for (bucket, place, _), shard in zip(parcels, shard_of)]
    schema = T._parse_datatype_string("bucket int, place int, shard int")
    chosen = placed.sparkSession.createDataFrame(found, schema)
    for parcels in reversed(below):
        chosen = parcels.join(chosen, ["bucket", "place"]).select(
            F.expr(f"item div {ways}").cast("int").alias("bucket"), (F.col("item") % ways).cast("int").alias("place"), "shard"
        )
    return chosen


def shards(docs: DataFrame, ways: int = SHARDS, buckets: int = BUCKETS, parts: int = PARTS, level: int = LEVEL) -> DataFrame:
    """Every row's doc_id, size, text_crc32, shard and slot."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "sizes")
    buckets = max(buckets, -(-rows.count() // BUCKET_ROWS))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")
    placed = materialize(_bucket_places(groups.select(bucket, "digest", "bytes"), ways), "places")
    chosen = _shard_of_places(placed, ways, buckets, level)
    chosen = F.broadcast(chosen) if buckets * ways <= BROADCAST_PARCELS else chosen
    of_group = placed.join(chosen, ["bucket", "place"]).select("digest", "shard")
    known = materialize(rows.join(of_group, "digest").select("doc_id", "size", "text_crc32", "shard", "row"), "sharded")
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    known = known.withColumn("part", part)
    counts = known.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "part").orderBy("row")
    slotted = known.withColumn("slot", F.row_number().over(inside) - 1).join(bases, ["shard", "part"])
    return slotted.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("slot")).alias("slot"))


def by_bytes(docs: DataFrame, ways: int = SHARDS) -> DataFrame:
    """The law of bytes: :func:`shards` with its name; nothing is said of one more shard."""
    return shards(docs, ways).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
