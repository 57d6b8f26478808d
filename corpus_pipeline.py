"""A corpus pipeline: five of the training-data operators, each a table that the next one reads.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept. All but the last return the
columns of ``docs``. The result has one row per document taken into the mix: its id, its number of tokens, and
digests of its token ids and of the text decoded from them.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from basketry.llm import bpe, lines, mixing, near_copies, quality  # noqa: E402
from basketry.llm.common import table, written  # noqa: E402
from basketry.llm.queries import RANKS  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("source_mix", source_mix), ("byte_bpe", byte_bpe)]

# Suffix arrays, 64-bit XXH digests and byte merges have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
