"""Substring search through an index of three-letter grams with their places.

Every place of a lower-cased text, its end included, begins one gram; grams beyond the end are filled up. A text
contains a needle if the needle's grams stand at consecutive places, so postings alone decide and no text is read
again. Needles of one or two letters are prefixes of grams, the empty one is the gram at the end. Stored in the order
of gram and key (``results.write_key_ordered``), a search reads the row groups of its grams only, and a gram that
most texts hold is cut over as many files as it fills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

GRAM, FILL = 3, "\0"


def postings(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``gram, <key>, place, rest``: from where in the text the gram stands, and how many letters the text has from there on.

    One row per letter and one more per text. A null text has none. Keys should be unique; rows of one key that repeat are found once.
    """
    low = texts.filter(F.col(text).isNotNull()).select(key, F.lower(text).alias("_low"))
    filled = F.concat("_low", F.lit(FILL * GRAM))
    grams = F.transform(F.sequence(F.lit(1), F.length("_low") + 1), lambda i: F.substring(filled, i, GRAM))
    rows = low.select(key, F.length("_low").alias("_length"), F.posexplode(grams).alias("place", "gram"))
    return rows.select("gram", key, "place", (F.col("_length") - F.col("place")).alias("rest"))


def find(index: DataFrame, key: str, needles: Sequence[str]) -> DataFrame:
    """``needle, <key>``: the keys whose text contains a needle, letter case aside. The needles are arguments of a search, not data."""
    if not needles:
        return index.select(F.lit("").alias("needle"), key).limit(0)
    # Lower case as Spark has it, which is that of the index.
    lowered = index.sparkSession.range(1).select(*[F.lower(F.lit(n)).alias(f"n{i}") for i, n in enumerate(needles)]).first()
    terms = [(number, at, gram) for number, low in enumerate(lowered) for at, gram in enumerate(_grams(low))]
    needed = F.element_at(F.array(*[F.lit(len(_grams(low))) for low in lowered]), F.col("number") + 1)
    # One condition per gram: the scan compares them with the statistics of its row groups.
    wanted = index.filter(_any([_stands(gram) for gram in sorted({gram for *_, gram in terms})]))
    held = F.array_compact(F.array(*[F.when(_stands(gram) & (F.col("rest") >= len(lowered[number]) - at),
                                            F.struct(F.lit(number).alias("number"), F.lit(at).alias("at"))) for number, at, gram in terms]))
    single = wanted.select(key, "place", F.inline(held)).withColumn("start", F.col("place") - F.col("at"))
    whole = single.groupBy("number", key, "start").agg(F.countDistinct("at").alias("n")).filter(F.col("n") == needed)
    names = F.array(*[F.lit(n) for n in needles])
    return whole.select(F.element_at(names, F.col("number") + 1).alias("needle"), key).distinct()


def _grams(low: str) -> list[str]:
    """The grams of a needle in order; the needle itself if it is shorter than one."""
    return [low[i:i + GRAM] for i in range(len(low) - GRAM + 1)] or [low]


def _stands(gram: str) -> Column:
    """A posting of the gram; of a shorter one, every gram that begins with it; of the empty one, the end of a text."""
    if not gram:
        return (F.col("gram") == FILL * GRAM) & (F.col("rest") == 0)
    return F.col("gram") == gram if len(gram) == GRAM else F.col("gram").startswith(gram)


def _any(conditions: list[Column]) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found
