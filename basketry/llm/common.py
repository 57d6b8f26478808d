"""What the training-data operators share: input tables, durable tables, words."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.session import shared_dir

# A word is a longest run of characters that are not ASCII white space. ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(folder, f"{name}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder all executors share: it is computed once, and a lost executor loses none of it."""
    spark = df.sparkSession
    path = posixpath.join(shared_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, one at a time; a null text is empty."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


# A document: whether it lacks an id, its id, a digest of its text. Rows that agree in all three are one document.
DOC = ["_none", "_id", "_text"]


def doc_key(docs: DataFrame) -> list[Column]:
    """The columns ``DOC``, none of them null; they sort by doc_id, rows without one last."""
    return [docs["doc_id"].isNull().alias("_none"), F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("_id"),
            F.coalesce(F.xxhash64(docs["text"]), F.lit(0)).alias("_text")]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def with_any_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let a function that returns the columns of its input work where names hold dots or back quotes."""
    @wraps(stage)
    def run(docs: DataFrame, *args, **named) -> DataFrame:
        names = docs.columns
        plain = docs.toDF(*(f"_column{i}" if "." in c or "`" in c else c for i, c in enumerate(names)))
        return stage(plain, *args, **named).toDF(*names)

    return run
