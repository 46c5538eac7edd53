"""Exact and near-duplicate removal, keep-first in ``pos`` order.

Both work on hashes and positions only; the texts never shuffle for a comparison.

Near-duplicate rule: in ``pos`` order, a row is dropped iff an earlier *kept* row
with the same first four tokens has word-3-gram Jaccard >= threshold.
The result is exact; the candidates are reduced in steps that cannot lose a pair:

1. Rows with the same block and shingle set collapse to the earliest. A set that
   cannot reach the threshold against any other set, or is alone in its block,
   needs no comparison.
2. Any two sets at or above the threshold share one of their first
   ``size - ceil(threshold * size) + 1`` shingles in any common order. The order
   is by frequency within the block, so buckets of rows sharing such a shingle are small.
   Large buckets lose the rows that cannot have enough in common from this shingle on;
   a bucket that is still larger than ``SPLIT_ROWS`` is split by a second shared shingle.
3. Buckets of at most ``PAIR_LIMIT`` rows are compared pairwise, once.
4. Larger buckets are never paired in full. Each round compares the earliest
   undecided rows of the bucket with each other, and only those of them that are
   kept with the rest of the bucket. A group of mutual copies, however large, is
   settled by its first row in one round; rows that are not alike are taken in
   doubling steps until none is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.functions.groups import with_shared_size
from millrace.session import materialize

PAIR_LIMIT = 64
SPLIT_ROWS = 1000
SPLIT_KEYS = 64
SALT_ROWS = 200_000
MAX_HEADS = 1000  # up to this width the rank filter is applied before the shuffle
LISTED_ROWS = 2_000_000  # up to so many positions or pairs are broadcast to shingle sets, which then stay where they lie
WIDE_BLOCK = 1_000_000  # up to so many rows in a block, rows of one shingle may meet in one partition
EPS = 1e-9


# ---------------------------------------------------------------- exact


def flag_exact_duplicates(df: DataFrame, pos: str = "pos", field: str = "question") -> DataFrame:
    """Add ``exact_dup``: an earlier row has the same normal form.

    The minimum per digest combines map-side, so a text shared by a third of all
    rows costs one partial row per task; the flag joins back on the unique ``pos``.
    """
    digest = F.sha2(text.dedup_text(F.col(field)), 256)
    first = df.select(pos, digest.alias("_key")).groupBy("_key").agg(F.min(pos).alias(pos))
    first = first.select(pos, F.lit(False).alias("exact_dup"))
    return df.join(first, pos, "left").withColumn("exact_dup", F.coalesce("exact_dup", F.lit(True)))


def exact_duplicates(df: DataFrame, pos: str = "pos", field: str = "question") -> DataFrame:
    """Positions of the rows whose normal form an earlier row has; only positions and digests shuffle."""
    keyed = df.select(F.col(pos).alias("pos"), F.sha2(text.dedup_text(F.col(field)), 256).alias("_key"))
    first = keyed.groupBy("_key").agg(F.min("pos").alias("pos")).select("pos")
    return keyed.select("pos").join(first, "pos", "left_anti")


def drops(df: DataFrame, threshold: float, pos: str = "pos", field: str = "question") -> DataFrame:
    """(pos, dropped): ``exact_dup`` or ``near_dup`` for every row that exact dedup and then near dedup drop.

    Both read the texts where they lie. The near step may look at exact duplicates too:
    they have the shingle set of their first row, so they are copies of it there and
    decide nothing about other rows.
    """
    exact = materialize(exact_duplicates(df, pos, field), "exact-dropped")
    near = near_duplicates(df, threshold, pos, field).join(exact, "pos", "left_anti")
    return exact.withColumn("dropped", F.lit("exact_dup")).unionByName(near.withColumn("dropped", F.lit("near_dup")))


# ---------------------------------------------------------------- near


def shingle_table(df: DataFrame, pos: str, field: str) -> DataFrame:
    """(pos, block, sh): hashed block key and sorted hashed shingle set."""
    toks = text.tokens(text.dedup_text(F.col(field)))
    return (
        df.select(F.col(pos).alias("pos"), toks.alias("_t"))
        .select("pos", F.xxhash64(text.block_key(F.col("_t"))).alias("block"), text.shingle_hashes(F.col("_t")).alias("sh"))
    )


def _required(size: Column, threshold: float) -> Column:
    """Common elements any partner at the threshold must share with a set of this size."""
    return F.ceil(F.lit(threshold) * size - EPS).cast("int")


def _overlap(size_a: Column, size_b: Column, threshold: float) -> Column:
    """Common elements two sets of these sizes need to reach the threshold."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (size_a + size_b) - EPS).cast("int")


def _alike_in_size(size_a: Column, size_b: Column, threshold: float) -> Column:
    return F.least(size_a, size_b) + EPS >= F.lit(threshold) * F.greatest(size_a, size_b)


def _at(rows: DataFrame, positions: DataFrame, label: str) -> DataFrame:
    """The rows at some positions. Up to ``LISTED_ROWS`` positions are broadcast, so that the rows themselves needn't shuffle."""
    return rows.join(_listed(positions.select("pos").distinct(), label), "pos", "left_semi")


def _listed(narrow: DataFrame, label: str) -> DataFrame:
    """A narrow table, written, and marked for broadcast if it has at most ``LISTED_ROWS`` rows."""
    narrow = materialize(narrow, label)
    return F.broadcast(narrow) if narrow.count() <= LISTED_ROWS else narrow


def _shared_shingles(sets: DataFrame) -> DataFrame:
    """(pos, block, size, t, n): the shingles that ``n`` >= 2 rows of a block have.

    Every shingle shuffles once: the counts are taken where the rows of a shingle meet, and the rows join them there.
    A row has a shingle once, so no more rows meet than the block has; blocks of more than
    ``WIDE_BLOCK`` rows count with partial sums first, and only they are written as rows.
    """
    wide = materialize(sets.groupBy("block").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > WIDE_BLOCK), "wide-blocks")
    columns = ["pos", "block", "size", F.explode("sh").alias("t")]
    if wide.isEmpty():
        return _met(sets.select(*columns))
    wide = F.broadcast(wide.select("block"))  # at most one for every WIDE_BLOCK rows
    rows = materialize(sets.join(wide, "block", "left_semi").select(*columns), "shingle-rows")
    shared = with_shared_size(rows, ["block", "t"], "shingle-counts")
    return _met(sets.join(wide, "block", "left_anti").select(*columns)).unionByName(shared)


def _met(rows: DataFrame) -> DataFrame:
    """Rows with a shingle of their block that another row has, and their number.

    Both readers ask for the same columns and neither adds a filter, so Spark shuffles the rows once for both;
    the count names all columns for that.
    """
    met = rows.where("block is not null and t is not null").repartition("block", "t")
    counts = met.groupBy("block", "t").agg(F.expr("count(pos, size)").alias("n")).where("n > 1")
    return met.join(counts, ["block", "t"])


def _prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(pos, block, size, first, p): the shared shingles a similar set may start with, and one more.

    The order is by frequency within the block, rarest first, then by hash. Shingles of one row only
    come before all others and are not listed. ``first`` is how many listed shingles
    lie in the prefix; ``p`` has each with ``rem``, the number of shingles from it to the end.
    """
    shared = _shared_shingles(sets)
    listed = shared.groupBy("pos", "block", "size").agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("s"))
    size, alone = F.col("size"), F.col("size") - F.size("s")
    first = F.least(size - _required(size, threshold) + 1 - alone, F.size("s"))
    return listed.select("pos", "block", "size", first.alias("first"), alone.alias("_alone"), "s").where("first > 0").select(
        "pos", "block", "size", "first",
        F.transform(
            F.slice("s", F.lit(1), F.col("first") + 1),
            lambda x, i: F.struct(x["t"].alias("t"), (F.col("size") - F.col("_alone") - i).alias("rem")),
        ).alias("p"),
    )


def _able(entries: DataFrame, threshold: float) -> DataFrame:
    """Entries of large buckets that may have a similar partner whose first common shingle is the bucket's.

    Such a pair has at most ``rem`` of either in common. Per bucket and size the largest ``rem`` is kept, and each
    (size, rem) of the bucket is held against it: rows with one template and different rests, however
    many, leave the template's buckets together. Only these small tables are joined.
    """
    kinds = materialize(entries.groupBy("block", "t", "size", "rem").agg(F.count(F.lit(1)).alias("_c")), "near-kinds")
    reach = kinds.groupBy("block", "t", F.col("size").alias("_size")).agg(F.max("rem").alias("_rem"))
    need = _overlap(F.col("size"), F.col("_size"), threshold)
    fine = _alike_in_size(F.col("size"), F.col("_size"), threshold) & (F.least("rem", "_rem") >= need)
    able = kinds.join(reach, ["block", "t"]).where(fine).select("block", "t", "size", "rem").distinct()
    return entries.drop("n").join(materialize(able, "near-able"), ["block", "t", "size", "rem"], "left_semi")


def _entries(prefixes: DataFrame, threshold: float) -> DataFrame:
    """Bucket entries (pos, block, t, size, rem, n): one per (row, prefix shingle) shared with another row.

    The k-th smallest common shingle of a similar pair lies among the first
    ``size - required + k`` of both. So a large bucket can be split by a second
    shingle, from the prefix extended by one, without losing a pair.
    """
    first = F.slice("p", F.lit(1), F.col("first"))
    single = materialize(prefixes.select("pos", "block", "size", F.inline(first)), "near-single")
    sized = materialize(with_shared_size(single, ["block", "t"], "bucket-sizes"), "near-sized")
    large = sized.where(F.col("n") > PAIR_LIMIT)
    columns = ["pos", "block", "t", "size", "rem", "n"]
    small = sized.where(F.col("n") <= PAIR_LIMIT).select(columns)
    if large.isEmpty():
        return small
    extra = {"_max": F.max("size"), "_min": F.min("size")}
    able = materialize(_able(large, threshold), "near-able-rows")
    entries = materialize(with_shared_size(able, ["block", "t"], "bucket-sizes", extra=extra), "near-entries")
    narrow = F.col("_max") - _required(F.col("_max"), threshold) + 1 <= SPLIT_KEYS
    dense = (F.col("n") > SPLIT_ROWS) & narrow & (_required(F.col("_min"), threshold) >= 2)
    split = entries.where(dense)
    rest = small.unionByName(entries.where(~dense).select(columns))
    if split.isEmpty():
        return rest
    at = F.array_position(F.transform("p", lambda x: x["t"]), F.col("t")).cast("int")
    after = F.transform(F.slice("p", at + 1, F.size("p")), lambda x: x["t"])
    pairs = (
        split.select("pos", "t", "rem").join(prefixes, "pos")
        .select("pos", "block", "size", "rem", "t", F.explode(after).alias("t2"))
        .select("pos", "block", "size", "rem", F.xxhash64("t", "t2").alias("t"))
    )
    pairs = with_shared_size(materialize(pairs, "near-double"), ["block", "t"], "bucket-sizes")
    return rest.unionByName(pairs.select(columns))


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified (a, b) among candidate pairs. Each row takes part in a bounded number of them.

    The pairs are written first and broadcast to the sets of their first rows, if not too many; only
    the sets of their second rows shuffle, to meet them.
    """
    pairs = materialize(pairs.select("a", "b").distinct(), "near-pairs")
    near_a = _at(sets, pairs.select(F.col("a").alias("pos")), "near-firsts")
    near_b = _at(sets, pairs.select(F.col("b").alias("pos")), "near-seconds")
    sa = near_a.select(F.col("pos").alias("a"), F.col("sh").alias("_sa"))
    sb = near_b.select(F.col("pos").alias("b"), F.col("sh").alias("_sb"))
    if pairs.count() <= LISTED_ROWS:
        pairs = F.broadcast(pairs)
    return (
        pairs.join(sa, "a").join(sb, "b")
        .where(text.jaccard(F.col("_sa"), F.col("_sb")) >= threshold)
        .select("a", "b")
    )


def _pairs_within(entries: DataFrame, threshold: float) -> DataFrame:
    """All ordered pairs inside buckets whose size the caller has bounded."""
    left = entries.select("block", "t", F.col("pos").alias("a"), F.col("size").alias("_na"), F.col("rem").alias("_ra"))
    right = entries.select("block", "t", F.col("pos").alias("b"), F.col("size").alias("_nb"), F.col("rem").alias("_rb"))
    near_size = _alike_in_size(F.col("_na"), F.col("_nb"), threshold)
    in_reach = F.least("_ra", "_rb") >= _overlap(F.col("_na"), F.col("_nb"), threshold)
    return left.join(right, ["block", "t"]).where((F.col("a") < F.col("b")) & near_size & in_reach).select("a", "b")


def _swept(kept_hot: DataFrame, rest: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Rows of large buckets similar to a newly kept earlier row of the same bucket.

    A kept row may face a third of the table, so both joins on it are salted by
    the bucket size. Only the sets of rows in a pair take part.
    """
    parts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    salt = F.pmod(F.xxhash64("pos"), parts)
    spread = rest.withColumn("_s", salt.cast("int"))
    copies = kept_hot.select(
        "block", "t", F.col("pos").alias("a"), F.col("size").alias("_na"), F.col("rem").alias("_ra"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_s"), parts.alias("_parts"),
    )
    near_size = _alike_in_size(F.col("_na"), F.col("size"), threshold)
    in_reach = F.least("_ra", "rem") >= _overlap(F.col("_na"), F.col("size"), threshold)
    pairs = (
        spread.join(copies, ["block", "t", "_s"])
        .where((F.col("a") < F.col("pos")) & near_size & in_reach)
        .groupBy("a", F.col("pos").alias("b"))
        .agg(F.max("_parts").alias("_parts"))
    )
    pairs = materialize(pairs, "near-swept")
    widest = kept_hot.groupBy(F.col("pos").alias("a")).agg(F.max(parts).alias("_w"))
    sets_a = (
        _at(sets, pairs.select(F.col("a").alias("pos")), "near-firsts")
        .select(F.col("pos").alias("a"), F.col("sh").alias("_sa"))
        .join(widest, "a")
        .withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_w") - 1)))
        .drop("_w")
    )
    sets_b = _at(sets, pairs.select(F.col("b").alias("pos")), "near-seconds")
    sets_b = sets_b.select(F.col("pos").alias("b"), F.col("sh").alias("_sb"))
    return (
        pairs.withColumn("_s", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int"))
        .join(sets_a, ["a", "_s"])
        .join(sets_b, "b")
        .where(text.jaccard(F.col("_sa"), F.col("_sb")) >= threshold)
        .select(F.col("b").alias("pos"))
        .distinct()
    )


def near_duplicates(df: DataFrame, threshold: float, pos: str = "pos", field: str = "question") -> DataFrame:
    """Positions of the rows that greedy keep-first removal drops.

    Shingles are made twice: of all rows for a narrow table of sizes and digests, and again of the rows that
    may have a partner. Only these are written.
    """
    sh = F.col("sh")
    sets = shingle_table(df, pos, field)
    brief = sets.select("pos", "block", F.size(sh).alias("size"), F.xxhash64(sh).alias("h1"), F.xxhash64(F.lit(7), sh).alias("h2"))
    brief = materialize(brief, "shingles")

    # One row per (block, shingle set), from narrow columns only.
    first = brief.groupBy("block", "h1", "h2").agg(F.min("pos").alias("pos"), F.max("size").alias("size"))
    first = materialize(first.select("pos", "block", "size"), "near-first")
    copies = brief.select("pos").join(first.select("pos"), "pos", "left_anti")
    # A set of this size can match another one only if gaining one element keeps it at the threshold.
    able = first.where(F.col("size") / (F.col("size") + 1) >= threshold)
    blocked = materialize(with_shared_size(able, ["block"], "block-sizes").select("pos"), "near-blocked")
    if blocked.count() <= LISTED_ROWS:
        texts = df.select(F.col(pos).alias("pos"), field).join(F.broadcast(blocked), "pos", "left_semi")
        usable = shingle_table(texts, "pos", field)
    else:  # hashes shuffle, never texts
        usable = materialize(sets, "all-sets").join(blocked, "pos", "left_semi")
    usable = materialize(usable.select("pos", "block", F.size(sh).alias("size"), "sh"), "near-sets")

    prefixes = materialize(_prefixes(usable, threshold), "near-prefixes")
    entries = _entries(prefixes, threshold)
    small = entries.where(F.col("n") <= PAIR_LIMIT)
    edges = materialize(_similar(_pairs_within(small, threshold), usable, threshold), "near-edges")
    hot = entries.where(F.col("n") > PAIR_LIMIT)
    dropped = _resolve(usable, edges, hot, threshold)
    return copies.unionByName(dropped)


def _resolve(sets: DataFrame, edges: DataFrame, hot: DataFrame, threshold: float) -> DataFrame:
    """Decide, in rounds, which rows are dropped; every decision rests on earlier rows only.

    Per round, a row is *ready* if it is among the earliest undecided rows of each
    of its large buckets: then every earlier similar row is known. Ready rows
    without an undecided similar row before them are kept, and whatever resembles
    a kept row is dropped.
    """
    is_hot = not hot.isEmpty()
    waiting = edges.select(F.col("b").alias("pos"))
    if is_hot:
        waiting = waiting.unionByName(hot.select("pos"))
    undecided = materialize(waiting.distinct(), "near-undecided")

    # Rows nobody waits for are kept from the start; what resembles them is dropped.
    settled_heads = edges.join(undecided.withColumnRenamed("pos", "a"), "a", "left_anti")
    out = materialize(settled_heads.select(F.col("b").alias("pos")).distinct(), "near-dropped")
    undecided = materialize(undecided.join(out, "pos", "left_anti"), "near-undecided")

    width = PAIR_LIMIT
    while not undecided.isEmpty():
        live = edges.join(undecided.withColumnRenamed("pos", "b"), "b", "left_semi").join(
            undecided.withColumnRenamed("pos", "a"), "a", "left_semi"
        )
        ready = undecided
        heads = live_hot = None
        if is_hot:
            live_hot = materialize(hot.join(undecided, "pos", "left_semi"), "near-hot")
            order = Window.partitionBy("block", "t").orderBy("pos")
            heads = live_hot.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= width).drop("_r")
            heads = materialize(heads, "near-heads")
            in_heads = heads.groupBy("pos").agg(F.count(F.lit(1)).alias("_in"))
            ready_hot = (
                live_hot.groupBy("pos").agg(F.count(F.lit(1)).alias("_all"))
                .join(in_heads, "pos").where(F.col("_in") == F.col("_all")).select("pos")
            )
            ready = undecided.join(live_hot, "pos", "left_anti").unionByName(ready_hot)
            found = _similar(_pairs_within(heads, threshold), sets, threshold)
            live = live.unionByName(found).distinct()
        live = materialize(live, "near-live")
        kept = materialize(
            ready.join(live.select(F.col("b").alias("pos")), "pos", "left_anti"), "near-kept"
        )
        drop = live.join(kept.withColumnRenamed("pos", "a"), "a", "left_semi").select(F.col("b").alias("pos"))
        if is_hot:
            kept_hot = heads.join(kept, "pos", "left_semi")
            rest = live_hot.join(kept, "pos", "left_anti")
            drop = drop.unionByName(_swept(kept_hot, rest, sets, threshold))
        drop = materialize(drop.distinct(), "near-dropped")
        out = out.unionByName(drop)
        undecided = materialize(
            undecided.join(kept, "pos", "left_anti").join(drop, "pos", "left_anti"), "near-undecided"
        )
        width = min(width * 2, MAX_HEADS)
    return out


def flag_near_duplicates(
    df: DataFrame, threshold: float, pos: str = "pos", field: str = "question"
) -> DataFrame:
    """Add ``near_dup`` to rows that already passed exact dedup."""
    dropped = near_duplicates(df, threshold, pos, field).select(F.col("pos").alias(pos), F.lit(True).alias("near_dup"))
    return df.join(dropped, pos, "left").withColumn("near_dup", F.coalesce("near_dup", F.lit(False)))
