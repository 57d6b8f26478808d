"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketry.llm import ann, bpe, importance, licenses, lines, mixing, quality, secret_scan, sharding, simhash, spelling, topk, toxicity
from basketry.llm.common import table

# Where the vocabulary lies; any other file of ranks can be named instead.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op4_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.fit_and_score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def op9_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.measure(table(spark, folder, "documents"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_entropy_mix, op2_byte_bpe, op3_licenses, op4_minimax_shards, op5_line_dedup, op6_toxicity, op7_simhash, op8_secrets, op9_top_k,
        op10_quality, op11_spelling, op12_importance, op13_neighbours)}
ORACLES: dict[str, str] = {"op3_licenses": licenses.SCAN_SQL, "op9_top_k": topk.TOP_K_SQL}
