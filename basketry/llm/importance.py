"""Importance resampling towards a target distribution, with hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks every separator of the UTF-8 bytes, ``bytes.split`` yields the words,
and the checksum of a word is the seed of the checksum of the next longer run, so a run's bucket costs one call
of ``zlib.crc32``. Counters of buckets are reduced per task, then over all tasks: first over the target texts and
over all documents for the gain of each bucket, then per document for its weight. Documents are drawn without
replacement by adding noise of extreme values (Gumbel) that follows from the id alone, so reruns agree.

The two tables of bucket counts have a fixed number of rows, and so has the table of gains that is sent to the
tasks. Texts are hashed in parts of ``CHUNK`` bytes, cut between words; memory is bounded but for a single longer
word. Scores are ranked by range partitions; a rank is the place in its partition plus the rows of those before.

Nulls: a null text has no words; a null doc_id hashes as an empty id and comes last among ties. Empty texts have
weight 0. Rows that repeat a doc_id are scored and ranked each; among equal rows the order is of no consequence.
Without target texts every bucket has the gain of none. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import texts, written

LONGEST_RUN, BUCKETS = 3, 10000
LEAST_WORDS, DRAWN_PERCENT, SEED, SCALE = 20, 5, 42, 1000
CHUNK = 1 << 20

# Lower case, and a blank for all that is neither a letter, a digit nor beyond ASCII.
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
BLANK = re.compile(b"[%s]" % re.escape(bytes(c for c in range(256) if TABLE[c] == 0x20)))


def word_parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time."""
    start = 0
    while start < len(text):
        cut = BLANK.search(text, start + CHUNK)
        end = cut.start() if cut else len(text)
        yield text[start:end].translate(TABLE).split()
        start = end


def bucket_parts(text: bytes, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Per part of a text the number of its words, and the buckets of the runs that end in it."""
    before: list[int] = []  # checksums of the runs of 1, 2, ... words that end at the last word so far
    for words in word_parts(text):
        if not words:
            continue
        spaced = [b" " + w for w in words]
        runs = [list(map(zlib.crc32, words))]
        for n in range(longest - 1):
            seeds = before[n:n + 1] + runs[-1][:-1]  # of the word before each
            runs.append(list(map(zlib.crc32, spaced[len(spaced) - len(seeds):], seeds)))
        yield len(words), np.array(list(chain.from_iterable(runs)), np.int64) % buckets
        before = [r[-1] for r in runs if r]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all texts of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            for text in texts(batch.column("text")):
                for _, part in bucket_parts(text, buckets=buckets):
                    found.update(part.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """What one feature of each bucket adds to a document's weight."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(SCALE * math.log((target.get(b, 0) + 1) * s_all / ((source.get(b, 0) + 1) * t_all))) for b in range(buckets)], np.int64)


def noise(doc_id: int | None) -> int:
    h = int(hashlib.sha256(b"%d:%s" % (SEED, b"" if doc_id is None else b"%d" % doc_id)).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` per document."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain.tolist())  # ``buckets`` numbers
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(shared.value, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                words = features = weight = 0
                for n, part in bucket_parts(text, buckets=buckets):
                    words, features, weight = words + n, features + len(part), weight + int(table[part].sum())
                rows.append((doc_id, words, features, weight, weight + noise(doc_id)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 5)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long")


def places(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``place``, 1 for the first in ``order``; equal rows stand in any order.

    Rows are dealt by ranges of the order and numbered where they lie. Only the number of rows of each
    partition comes to the driver, and goes back as that many offsets.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that agree in the order are told apart by a number, so that ranges can cut between them.
    apart = written(rows.withColumn("_apart", F.monotonically_increasing_id()), "unplaced")
    order = [*order, F.col("_apart")]
    dealt = apart.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt.drop("_apart"), "dealt")
    sizes = sorted(dealt.groupBy(F.shiftright("_at", 33).cast("int").alias("_part")).count().collect())
    starts = list(zip((r["_part"] for r in sizes), np.cumsum([0, *(r["count"] for r in sizes)]).tolist()))
    start = rows.sparkSession.createDataFrame(starts, "_part int, _start long")  # a row per partition
    placed = dealt.withColumn("_part", F.shiftright("_at", 33).cast("int")).join(F.broadcast(start), "_part")
    return placed.withColumn("place", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_start", "_at")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` per document of ``docs``; rank is null for those not drawn."""
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(t, buckets).collect()} for t in (docs, target)]  # at most ``buckets`` rows each
    scored = written(weigh(docs, gains(*counts, buckets)), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    placed = places(able, [F.desc("score"), F.asc_nulls_last("doc_id")])
    ranked = placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    return ranked.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
