"""The corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written
and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, line_crf, packing, simhash
from millrace.llm.common import table
from millrace.llm.queries import BYTE_FILE
from millrace.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stand mostly in content lines."""
    return line_crf.keep_good(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that occurs in them; those that read like noise go."""
    return langid.keep_known(docs, langid.train_on(docs, with_noise=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(BYTE_FILE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("language", language),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

#: Trained models and packing can't be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
