"""Readers: instruction pairs, golden set, knowledge base, chat data, log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.config import IngestRules
from millrace.functions import text
from millrace.functions.hashing import seeded_order
from millrace.functions.ranks import keys_at_ranks
from millrace.operators.chat import CHAT_SCHEMA
from millrace.session import materialize

GOLDEN_SCHEMA = "question string, must_contain array<string>, must_not_contain array<string>, category string"
KB_SCHEMA = "id string, text string"
SUBMIX_UNKNOWN = "unknown"


class NothingIngested(ValueError):
    """Raised when a source yields no rows."""


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, pos, line): every line of the text files under ``path``.

    ``line_no`` counts from 1 within a file and ``pos`` from 0 over all files in
    path order. The lines are read once and written with their place in their file
    split; another scan could cut the files elsewhere. Rows of one file split keep their order,
    so a count per split (one row each) gives every split's offset; files stay splittable and are
    never held as one row.
    """
    raw = materialize(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("line"),
        ),
        "lines",
    )
    splits = raw.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    in_file = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    sized = materialize(
        splits.withColumn("_before", F.coalesce(F.sum("_n").over(in_file), F.lit(0))), "line-splits"
    )
    in_all = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = sized.groupBy("file").agg(F.sum("_n").alias("_rows"))
    files = files.select("file", F.coalesce(F.sum("_rows").over(in_all), F.lit(0)).alias("_files_before"))
    offsets = materialize(sized.join(files, "file").drop("_n"), "line-offsets")
    at = F.col("_before") + F.col("_id") - F.col("_first")
    at = F.coalesce(at, F.raise_error(F.lit("a line without an offset")).cast("long"))
    return raw.join(offsets, ["file", "_start"], "left").select(
        "file", (at + 1).alias("line_no"), (at + F.col("_files_before")).alias("pos"), "line"
    )


def category_of(row_id: Column) -> Column:
    """Lower-cased text before the first dot of an id; an empty id is ``unknown``."""
    return F.when(row_id.isNull() | (row_id == ""), F.lit(SUBMIX_UNKNOWN)).otherwise(
        F.lower(F.substring_index(row_id, ".", 1))
    )


def read_local_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs from JSON lines; malformed JSON fails the job.

    ``response`` wins over ``answer`` whenever the key is there, even with a null.
    """
    lines = numbered_lines(spark, path).where(~text.is_blank(F.col("line")))
    v = F.col("_v")

    def has(name: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", "variant").isNotNull()

    def get(name: str) -> Column:
        return F.when(has(name), F.try_variant_get(v, f"$.{name}", "string"))

    def present(name: str) -> Column:
        return F.when(has(name), get(name)).otherwise(F.lit(""))

    answer = F.when(has("response"), get("response")).when(has("answer"), get("answer")).otherwise(F.lit(""))
    given = get("category")
    return lines.withColumn("_v", F.parse_json("line")).select(
        "pos",
        present("id").alias("id"),
        present("question").alias("question"),
        answer.alias("answer"),
        present("system_prompt").alias("orig_system_prompt"),
        F.coalesce(F.when(given != "", given), category_of(present("id"))).alias("category"),
        F.url_decode(F.replace(F.element_at(F.split("file", "/"), -1), F.lit("+"), F.lit("%2B"))).alias("source"),
    )


def read_corpus(rows: DataFrame, source: str, rules: IngestRules = IngestRules()) -> DataFrame:
    """Pairs from a corpus table (id, question, response, system_prompt).

    The category filter comes before the cap, which samples by seeded hash order
    up to ``max_docs`` rows.
    """
    def filled(name: str) -> Column:
        return F.coalesce(name, F.lit(""))

    pairs = rows.select(
        filled("id").alias("id"),
        filled("question").alias("question"),
        filled("response").alias("answer"),
        filled("system_prompt").alias("orig_system_prompt"),
        category_of(F.col("id")).alias("category"),
        F.lit(source).alias("source"),
    )
    if rules.keep_categories:
        pairs = pairs.where(F.col("category").isin(*rules.keep_categories))
    return seeded_cap(pairs, rules.max_docs, rules.seed)


def _sampling_key(df: DataFrame, seed: int, row_id: str) -> Column:
    """Seeded hash of the id, then a digest of the whole row: only rows that are equal in all tie."""
    blank = F.coalesce(F.col(row_id).cast("string"), F.lit("")) == ""
    content = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    return F.concat(F.when(blank, F.sha2(F.concat(F.lit(f"{seed}|"), content), 256)).otherwise(seeded_order(seed, F.col(row_id))), F.lit("|"), content)


def seeded_cap(df: DataFrame, rows: int, seed: int, row_id: str = "id") -> DataFrame:
    """The first ``rows`` rows in seeded hash order: a uniform sample, the same under any partitioning.

    The hash at that rank is found exactly and compared with each row's, so a
    large sample is not gathered in one task the way a sorted limit is. Ids may be
    blank or repeat: rows then go by their content, and of rows that are equal
    throughout as many are taken as still fit. Only rows without an id and those
    that tie at the cut are digested.
    """
    blank = F.coalesce(F.col(row_id).cast("string"), F.lit("")) == ""
    content = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    own = F.when(blank, F.sha2(F.concat(F.lit(f"{seed}|"), content), 256)).otherwise(seeded_order(seed, F.col(row_id)))
    first = _cut(df.withColumn("_k", own), rows)
    if first is None:
        return df
    below, tied, left = first
    second = _cut(tied.drop("_k").withColumn("_k", content), left)
    if second is None:
        return below.unionByName(tied).drop("_k")
    inside, equal, left = second
    return below.unionByName(inside).unionByName(equal.limit(left)).drop("_k")


def _cut(keyed: DataFrame, rows: int) -> tuple[DataFrame, DataFrame, int] | None:
    """The rows with keys below that at the rank, the rows with that very key, and how many of those still fit; None if all fit."""
    wanted = keyed.sparkSession.createDataFrame([(0, "cap", rows)], "_g int, name string, rank long")
    cut = keys_at_ranks(keyed.select(F.lit(0).alias("_g"), "_k"), ["_g"], "_k", wanted).first()
    if cut is None:
        return None
    return keyed.where(F.col("_k") < cut["cut"]), keyed.where(F.col("_k") == cut["cut"]), cut["at_cut"]


def with_pos(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add ``pos``, a position that follows ``order``: range-sorted partitions numbered in sequence.

    Written once: range bounds are sampled anew by every action and would move the numbers.
    """
    return materialize(df.orderBy(*order).withColumn("pos", F.monotonically_increasing_id()), "positions")


def ingest(
    spark: SparkSession, mode: str, location: str | DataFrame, rules: IngestRules = IngestRules(), source: str = "corpus"
) -> DataFrame:
    """Read pairs by mode: ``corpus`` (a corpus table or path), ``sample`` or ``local_kb`` (JSON lines)."""
    if mode == "corpus":
        rows = location if isinstance(location, DataFrame) else spark.read.parquet(location)
        pairs = read_corpus(rows, source, rules)
        pairs = with_pos(pairs, [seeded_order(rules.seed, F.col("id")), _sampling_key(pairs, rules.seed, "id")])
    elif mode in ("sample", "local_kb"):
        pairs = read_local_pairs(spark, location)
    else:
        raise ValueError(f"unknown source mode: {mode}")
    if pairs.isEmpty():
        raise NothingIngested(f"no records ingested for source mode {mode}")
    return pairs


def category_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden cases with ``case_id``, their line order."""
    lines = numbered_lines(spark, path).where(~text.is_blank(F.col("line")))
    case = F.from_json("line", GOLDEN_SCHEMA, {"mode": "FAILFAST"})
    return lines.select(F.col("pos").alias("case_id"), case.alias("c")).select("case_id", "c.*")


def read_kb(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge-base chunks (id, text); a missing file is an empty base, not an error."""
    try:
        found = spark.read.schema(KB_SCHEMA).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], KB_SCHEMA)
    return found.select(F.coalesce("id", F.lit("")).alias("id"), "text")


def read_chat(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHAT_SCHEMA).json(path)
