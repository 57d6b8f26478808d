"""Spelling variants: words that one edit turns into a much more frequent word.

Words are rows of matrices of code points, padded to one width, aligned left and right. Two blocks of words are
compared row by row as a dense tile: the lengths of the common prefix and of the common suffix of two words add up
to the longer length less one, or more, exactly if one code point is inserted, deleted or replaced between them.

Only tiles that can hold such a pair are laid. Where the longer word has m code points, a pair has the first or the
last m // 2 in common (half of all but the edit), so blocks are made of words that agree in that half. A half
that very many words share is cut into blocks of about ``BLOCK`` words by a hash, and each two of its blocks are a
tile of their own: nothing is capped. A pair with both halves in common counts in the tile of its first half.

A tile returns one row per word with near words: their number and the best one. Forms are followed to the last by
doubling (a form is five times as frequent, so a chain is short).

Nulls: a null text has no words; a null doc_id hashes as an empty id. Very long texts are cut in parts between
words. Ties between near words go to the first in code-point order. Repeated rows count each. Without words the
result is empty. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import texts, written

LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
SLIP = 199  # one distinct word of a document in so many loses a code point
BLOCK, TILE_PAIRS = 512, 1 << 18
CHUNK, MOST_HELD = 1 << 20, 1 << 18

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
LETTER = re.compile(r"[a-zÀ-ÿ]*")


def slipped(prefix: int, run: str) -> str:
    """The run as it is counted; ``prefix`` is the checksum of the document's id and a colon."""
    h = zlib.crc32(run.encode(), prefix)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def parts(text: str) -> Iterator[str]:
    """A text in parts of bounded size that cut no word."""
    start = 0
    while start < len(text):
        end = LETTER.match(text, min(start + CHUNK, len(text))).end()
        yield text[start:end]
        start = end


def words_of(docs: DataFrame) -> DataFrame:
    """``word, n``: the distinct words of all texts that are long and frequent enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                prefix, own = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id), Counter()
                for part in parts(text.lower().decode(errors="replace")):  # bytes: only A-Z change
                    own.update(RUN.findall(part))
                for word, n in own.items():
                    total[slipped(prefix, word)] += n
                if len(total) > MOST_HELD:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    def rows(total: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in total.items() if len(w) >= LEAST_LENGTH}
        return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def tiles(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``m, first, a, b``: blocks of words (with their counts) that agree in a half; ``b`` is null where a block meets itself."""
    size = F.length("word")
    classes = words.withColumn("m", F.explode(F.array(size, size + 1))).withColumn("first", F.explode(F.array(F.lit(True), F.lit(False))))
    half = F.expr("CASE WHEN first THEN left(word, m div 2) ELSE right(word, m div 2) END")
    keyed = classes.withColumn("half", half)
    key = ["m", "first", "half"]
    met = keyed.groupBy(*key).agg(F.count("*").alias("_all"), F.count_if(size == F.col("m")).alias("_long")).filter("_all > 1 AND _long > 0")
    blocks = met.select(*key, F.ceil(F.col("_all") / block).cast("int").alias("of"))
    placed = keyed.join(blocks, key).withColumn("no", F.pmod(F.xxhash64("word"), F.col("of")).cast("int"))
    held = placed.groupBy(*key, "of", "no").agg(F.collect_list(F.struct("word", "n")).alias("words"))
    alone = held.filter("of = 1").select("m", "first", F.col("words").alias("a"), F.lit(None).cast(held.schema["words"].dataType).alias("b"))
    many = held.filter("of > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    many = many.withColumn("low", F.least("no", "other")).withColumn("high", F.greatest("no", "other"))
    two = many.groupBy(*key, "low", "high").agg(F.max(F.when(F.col("no") == F.col("low"), F.col("words"))).alias("a"),
                                               F.max(F.when((F.col("no") == F.col("high")) & (F.col("low") < F.col("high")), F.col("words"))).alias("b"))
    return alone.unionByName(two.filter("a IS NOT NULL AND (low = high OR b IS NOT NULL)").select("m", "first", "a", "b"))


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, padded, from the left and from the right; and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max(initial=1))
    left = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
    right = np.array([w[::-1] for w in words], f"<U{width}").view(np.uint32).reshape(len(words), width)
    return left, right, sizes


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading columns two matrices have in common, row by row, at most ``most``."""
    unlike = a != b
    first = unlike.argmax(axis=1)
    return np.minimum(np.where(unlike.any(axis=1), first, a.shape[1]), most)


def near(words: list[str], i: np.ndarray, j: np.ndarray, m: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which pairs of words number ``i`` and ``j`` are one edit apart, have m code points at most, and count in their tile."""
    left, right, sizes = matrices(words)
    longer, shorter = np.maximum(sizes[i], sizes[j]), np.minimum(sizes[i], sizes[j])
    able = np.flatnonzero((longer == m) & (longer - shorter <= 1))
    out = np.zeros(len(i), bool)
    i, j, longer, shorter = i[able], j[able], longer[able], shorter[able]
    before, after = common(left[i], left[j], shorter), common(right[i], right[j], shorter)
    out[able] = (before + after >= longer - 1) & (first[able] | (before < m[able] // 2))
    return out


def links(laid: DataFrame) -> DataFrame:
    """``word, n_near, best``: per word and task the number of its near words and the best one (count, word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pairs = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in ("m", "first", "a", "b"))):
                size = len(row[2]) * len(row[3] or row[2])
                if rows and pairs + size > TILE_PAIRS:
                    yield compared(rows)
                    rows, pairs = [], 0
                rows.append(row)
                pairs += size
            yield compared(rows)

    def compared(rows: list) -> pa.RecordBatch:
        words: list[dict] = []
        index: list[tuple] = []
        for m, first, a, b in rows:
            p, q, start = len(a), len(b or a), len(words)
            words += a + (b or [])
            at = np.arange(p * q)
            i, j = at // q, at % q
            kept = i < j if b is None else slice(None)
            i, j = start + i[kept], start + (p if b else 0) + j[kept]
            index.append((i, j, np.full(len(i), m), np.full(len(i), first)))
        best: dict[str, tuple] = {}
        if index:
            i, j, m, first = map(np.concatenate, zip(*index))
            found = near([w["word"] for w in words], i, j, m, first)
            for x, y in zip(i[found].tolist(), j[found].tolist()):
                for own, other in ((words[x], words[y]), (words[y], words[x])):
                    count, least = best.get(own["word"], (0, (0, "")))
                    mine = (-other["n"], other["word"])
                    best[own["word"]] = (count + 1, min(least, mine) if count else mine)
        names = ["word", "n_near", "less", "form"]
        return pa.RecordBatch.from_arrays([
            pa.array(list(best), pa.string()), pa.array([c for c, _ in best.values()], pa.int64()),
            pa.array([b[0] for _, b in best.values()], pa.int64()), pa.array([b[1] for _, b in best.values()], pa.string())], names=names)

    # Tiles are dealt anew: a range of words can hold most of them.
    spread = laid.repartition(int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(run, "word string, n_near long, less long, form string")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms reached from each word that has one (columns ``word, form``)."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        # As many words as a word has near ones can share a root: their number is bounded by its length and the alphabet.
        step = written(at.join(onward, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return at


def variants(docs: DataFrame, factor: int = FACTOR, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of the texts."""
    words = written(words_of(docs), "words")
    found = links(written(tiles(words, block), "tiles")).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))
    best_n = -F.col("best.less")
    stats = written(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best_n >= factor * F.col("n"), F.col("best.form")).alias("form"), F.when(best_n >= factor * F.col("n"), best_n).cast("long").alias("form_n")), "near-words")
    last = roots(stats.filter("form IS NOT NULL"))
    return stats.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
