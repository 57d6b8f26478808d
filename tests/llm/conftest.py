import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """n words that look alike in no two seeds."""
    return " ".join(WORDS[(seed * 7 + i * i * (seed % 5 + 1) + i) % len(WORDS)] + str((seed * 31 + i) % 97) for i in range(n))


# Nulls in any column, empty and long texts, ties, repeated rows, white space that is no separator.
AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t\n ", "en", "a", 5), (4, "one", "en", None, 3),
    (5, "x" * 30000, "en", "b", 30000), (6, "same text here", "en", "b", 14), (6, "same text here", "en", "b", 14), (7, "same text here", "de", "a", 14),
    (None, "no id at all", "en", "b", 12), (None, None, None, None, None), (8, "tab\tand\x0bvt nbsp em \x1cfs", "fr", "a", 20), (9, "\U0001f600 é ß 中文 ", "zh", "c", 9),
]


@pytest.fixture(scope="session")
def docs(spark):
    def build(rows, extra=()):
        df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
        from pyspark.sql import functions as F
        return df.withColumns({c: F.lit(i) for i, c in enumerate(extra)})
    return build


@pytest.fixture(scope="session")
def awkward(docs):
    return docs(AWKWARD, ("size", "component_id", "kept", "gone", "_id", "key", "shard"))


@pytest.fixture(scope="session")
def empty(docs):
    return docs([])


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
