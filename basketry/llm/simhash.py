"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; two
fingerprints within the radius share a variant. Rows are shuffled on the
variant. A variant's bucket is kept as a bit mask of its members (which of the
64 bits each differs in, or none), so it has at most 65 and a fixed size, and
equal fingerprints are one row before anything is emitted. All members of a
bucket lie within the radius of each other, so a star to the smallest, verified
link by link, keeps every connection.

Nulls: a null or empty text has fingerprint zero, linked like any other. A null
doc_id is never the id of a component unless all of its rows have none. Repeated
rows get the same result each. Texts of any length are read whole, their shingles
in parts. The smallest doc_id names a component, so there are no ties. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import DOC, doc_key, fresh, texts, written
from basketry.llm.graph import components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
CHUNK = 1 << 16


def fingerprint(text: bytes, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a text as a signed 64-bit number."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space cuts
    if not words:
        return 0
    n = min(words_in_shingle, len(words))
    count = len(words) - n + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, count, CHUNK):  # bounded memory for any length of text
        part = words[start:min(start + CHUNK, count) + n - 1]
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(n)))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t) for t in texts(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def links(distinct: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all at ``RADIUS`` or fewer differing bits."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    # Each row becomes 65: they are dealt to as many tasks as a shuffle has before they grow. The planner knows rows
    # grouped by fp to be dealt by it already and would drop a deal by fp itself.
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = distinct.repartition(parts, F.xxhash64("fp")).select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i")).select(
        F.when(F.col("i") == 64, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(bit(F.col("i")))).alias("variant"),
        F.when(F.col("i") == 64, F.lit(0)).otherwise(bit(F.col("i"))).cast("long").alias("bit"), (F.col("i") == 64).alias("itself"))
    buckets = variants.groupBy("variant").agg(F.bit_or("bit").alias("mask"), F.max("itself").alias("itself"))
    met = buckets.filter(F.bit_count("mask") + F.col("itself").cast("int") > 1)
    flips = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("mask").bitwiseAND(bit(i)) != 0)
    members = F.concat(F.transform(flips, lambda i: F.col("variant").bitwiseXOR(bit(i))), F.when(F.col("itself"), F.array("variant")).otherwise(F.array().cast("array<bigint>")))
    stars = met.select(members.alias("members")).select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return stars.filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per document: the smallest doc_id reachable over links, itself included."""
    rows = written(fingerprints(docs), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    labelled = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component with all its columns: that with the smallest doc_id.

    Documents without doc_id come last, equal ids by a digest of the text. Rows that agree
    in doc_id and text are one document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t) for t in texts(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in DOC), fps], names=[*DOC, "fp"])

    rows = written(docs.select(*doc_key(docs), "text").mapInArrow(run, "_none boolean, _id long, _text long, fp long").distinct(), "fingerprints")
    return one_of_each(docs, rows, "fp", components(links(rows.select("fp").distinct())))


def one_of_each(docs: DataFrame, rows: DataFrame, name: str, roots: DataFrame) -> DataFrame:
    """The first document, by ``DOC``, of each component; ``rows`` has ``DOC`` and the node ``name``, ``roots`` the nodes that are linked."""
    labelled = rows.join(roots.withColumnRenamed("node", name), name, "left").withColumn("root", F.coalesce("root", name))
    key = [fresh(docs, c) for c in DOC]
    # As a table of its own it lets Spark measure the join with the texts.
    chosen = written(labelled.groupBy("root").agg(F.min(F.struct(*DOC)).alias("d")).select(*(F.col(f"d.{c}").alias(k) for c, k in zip(DOC, key))), "chosen")
    named = docs.select("*", *(c.alias(k) for c, k in zip(doc_key(docs), key)))
    return named.join(chosen, key, "left_semi").dropDuplicates(key).select(*docs.columns)
