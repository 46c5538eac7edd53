"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    embedding_dedup, encode, importance, langid, license_scan, line_crf, lm_score, packing, pretokens, sharding, simhash, turn_repair, wrapper,
)
from millrace.llm.common import table

WORD_FILE, BYTE_FILE, RANK_FILE = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.summary(license_scan.detect(docs))


def op2_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode.digests(encode.encode(docs, public_tokenizers.path(WORD_FILE), decoded=True))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.by_bytes(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train_on(docs))


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.judge(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_FILE))


def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))


def op12_pretokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    return pretokens.digests(pretokens.encode(docs, path, pattern, decoded=True))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_hmm": op2_hmm,
    "op3_bpe": op3_bpe,
    "op4_sharding": op4_sharding,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_wrappers": op6_wrappers,
    "op7_language": op7_language,
    "op8_line_crf": op8_line_crf,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    "op11_turns": op11_turns,
    "op12_pretokens": op12_pretokens,
    "op13_resampling": op13_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op1_licenses": license_scan.oracle(),
    "op13_resampling": importance.oracle(),
}
