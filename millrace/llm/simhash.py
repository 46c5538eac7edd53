"""SimHash near-duplicates: fingerprints of four-word shingles, linked within a Hamming radius by BK-trees.

Equal fingerprints are one node from the start. The 64 bits are cut into bands; two
fingerprints within the radius agree in all but ``radius`` bands, so every choice of
the other bands is a shard key and each link is inside some shard. The number of bands
follows the number of fingerprints so that shards stay small; the links found are the
same for any number. A shard larger than ``SHARD`` is cut into parts, and the parts
are compared two by two in tasks of their own.

In a task a shard's fingerprints stand in a BK-tree: children are keyed by their integer
Hamming distance to the parent, and a search follows only edges within the radius. The
trees are built where their shard is shuffled to. They aren't broadcast: all of them
together grow with the data. Only links that join two trees' sets are passed on, a
forest per shard, which keeps every component whole.

Null and empty texts have no shingle and the fingerprint zero. A null doc_id belongs to
the component of its fingerprint but is nobody's smallest id. Repeated rows give repeated
results. Empty input gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_BYTES, texts_of
from millrace.llm.components import components
from millrace.session import materialize

RADIUS, WORDS, SEED = 4, 4, 42
#: Most fingerprints in one tree, and wished for on average.
SHARD, USUAL = 2048, 64


def fingerprint(text: bytes) -> int:
    """Bit i is set if it is set in over half the shingles' XXH64 values."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[: len(words) - WORDS]].tolist()
    stops = (ends[WORDS - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[a : a + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in texts_of(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


class BkTree:
    """Fingerprints by number; the children of a node are keyed by their distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Numbers of all fingerprints within the radius."""
        found, stack = [], [0] if self.values else []
        values, children = self.values, self.children
        while stack:
            at = stack.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            kids = children[at]
            if kids:
                low, high = distance - radius, distance + radius
                stack.extend(child for edge, child in kids.items() if low <= edge <= high)
        return found

    def add(self, value: int) -> None:
        number = len(self.values)
        at = 0
        while number:
            edge = (self.values[at] ^ value).bit_count()
            if edge not in self.children[at]:
                self.children[at][edge] = number
                break
            at = self.children[at][edge]
        self.values.append(value)
        self.children.append({})


def _forest(left: list[int], right: list[int] | None, radius: int) -> Iterator[tuple[int, int]]:
    """Links of a shard, or between two parts of one; only those that join sets not yet joined."""
    values = left + (right or [])
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tree = BkTree()
    if right is not None:
        for value in left:
            tree.add(value)
    for number in range(0 if right is None else len(left), len(values)):
        for other in tree.near(values[number], radius):
            a, b = root(number), root(other)
            if a != b:
                parent[a] = b
                yield values[number], values[other]
        if right is None:
            tree.add(values[number])


def band_plan(count: int, radius: int = RADIUS, usual: int = USUAL) -> list[int]:
    """The bit masks of the shard keys for so many fingerprints."""
    bands = radius + 1
    while bands < 10 and count / 2 ** (64 * (bands - radius) / bands) > usual and comb(bands + 1, radius) <= 126:
        bands += 1
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, bands - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def node(rep: str, fp: str) -> Column:
    """A fingerprint as a node: the one with the smallest document comes first, so that a component's root holds its id."""
    return F.struct(F.col(rep).isNull().alias("none"), F.col(rep).alias("rep"), F.col(fp).alias("fp"))


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD, masks: list[int] | None = None) -> DataFrame:
    """Links ``a``, ``b`` that join all fingerprints within the radius; ``prints`` is a written table of distinct ``fp``.

    Where it has the smallest doc_id of each, ``rep``, the links have those of both as ``a_rep`` and ``b_rep``.
    """
    carried = "rep" in prints.columns
    names = ["a", "b", "a_rep", "b_rep"]
    reps = F.col("rep") if carried else F.lit(None)
    prints = prints.select("fp", reps.cast("long").alias("rep"))
    masks = masks or band_plan(prints.count(), radius)
    keys = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for i, m in enumerate(masks)])
    rows = prints.select("fp", "rep", F.inline(keys))
    sizes = rows.groupBy("m", "v").count().where(F.col("count") > 1)
    sizes = materialize(sizes.select("m", "v", F.ceil(F.col("count") / shard).cast("int").alias("parts")), "shard-sizes")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells: Column = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda t: F.struct(F.least(t, own).alias("i"), F.greatest(t, own).alias("j"), (own > t).alias("second")),
    )
    dealt = rows.join(sizes, ["m", "v"]).select("m", "v", "fp", "rep", F.inline(cells))
    cell = ["m", "v", "i", "j"]
    dealt = dealt.repartition(*[F.col(c) for c in cell]).sortWithinPartitions(*cell, "second", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = ()
        left: list[int] = []
        right: list[int] = []
        known: dict[int, int | None] = {}
        out: list[tuple[int, int]] = []
        ids: list[tuple[int | None, int | None]] = []

        def close() -> None:
            if held:
                found = list(_forest(left, None if held[2] == held[3] else right, radius))
                out.extend(found)
                ids.extend((known[a], known[b]) for a, b in found)

        def packed() -> pa.RecordBatch:
            made = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            sides = [pa.array([pair[i] for pair in ids], pa.int64()) for i in (0, 1)]
            out.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1]), *sides], names=names)

        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in (*cell, "second")}
            values = batch.column("fp").to_numpy().view(np.uint64).tolist()
            reps = batch.column("rep").to_pylist()
            for *key, second, value, rep in zip(*(columns[c] for c in cell), columns["second"], values, reps):
                if tuple(key) != held:
                    close()
                    held, left, right = tuple(key), [], []
                    known.clear()
                known[value] = rep
                (right if second else left).append(value)
            if len(out) > 10_000:
                yield packed()
        close()
        yield packed()

    made = dealt.mapInArrow(run, "a long, b long, a_rep long, b_rep long")
    return made if carried else made.select("a", "b")


def groups(prints: DataFrame) -> DataFrame:
    """Every document's ``fp`` and ``component_id``; ``prints`` is a written table of :func:`fingerprints`."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprints")
    found = links(nodes).select(node("a_rep", "a").alias("a"), node("b_rep", "b").alias("b"))
    rooted = components(found).select(F.col("node.fp").alias("fp"), F.col("root"))
    joined = nodes.join(rooted, "fp", "left")
    own = F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("root.rep"))
    known = materialize(joined.select("fp", own.alias("component_id")), "components")
    return prints.join(known, "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    found = groups(materialize(fingerprints(docs), "simhash"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: that with the smallest doc_id.

    Of rows with that same doc_id one stays; of a group without any doc_id, one stays. Rows are numbered
    as they are written, so the choice is the same when a task is repeated.
    """
    names = docs.columns
    numbered = materialize(docs.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")
    flat = numbered.select("number", F.col("row.doc_id").alias("key"), F.col("row.text").alias("text"))
    prints = materialize(fingerprints(flat.select(F.col("number").alias("doc_id"), "text")), "simhash")
    found = groups(prints).select(F.col("doc_id").alias("number"), F.col("component_id").alias("group"))
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("number"))
    ids = numbered.select("number", F.col("row.doc_id").alias("key"))
    first = found.join(ids, "number").groupBy("group").agg(F.min(order).alias("first"))
    return numbered.join(first.select(F.col("first.number").alias("number")), "number", "left_semi").select("row.*")
