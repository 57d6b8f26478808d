"""Quality rules: how much of a text repeats itself.

The characters inside repeated word n-grams of several lengths, and inside
repeated lines, are measured with rolling hashes in numpy, one text at a time.
An n-gram is repeated if the same words occurred before in the same text.
Windows with equal hashes are compared word by word, so hashes only save time.

Nulls: a null or empty text has no words and is rejected (too short). A text is
measured whole, in memory of some 20 times its size. Of equal n-grams or lines the
first in the text is the original. An empty table gives no rows. Repeated rows are
measured each. Columns beyond those named are passed through by ``keep`` and
ignored by ``measure``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import texts, with_any_names

# A text is rejected if more of its characters lie in n-grams, or in lines, that it held before. The limit leaves
# room for a short text that carries one boilerplate line twice.
LENGTHS = (5, 6, 7, 8, 9, 10)
CHAR_LIMIT = 0.30
SLICE_ROWS = 500
MIN_WORDS = 50
REPEAT_WINDOW, REPEAT_PERCENT = 3, 50

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, dup_line_chars double, "
          + ", ".join(f"dup_{n}gram_chars double" for n in LENGTHS))


def equal_windows(ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows of ``n`` words at ``starts`` (ascending): which occur twice or more, and which occurred before."""
    twice, again = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    a, b = starts[order[:-1][same]], starts[order[1:][same]]
    if any((ids[a + k] != ids[b + k]).any() for k in range(n)):  # two different windows share a hash: compare the words instead
        _, inverse = np.unique(np.stack([ids[starts + k] for k in range(n)], axis=1), axis=0, return_inverse=True)
        return equal_windows(ids, inverse.reshape(-1).astype(np.uint64), starts, n)
    again[order[1:][same]] = True
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return twice, again


def covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a window of ``n`` words at one of ``starts``."""
    edges = np.bincount(starts, minlength=words + 1) - np.bincount(starts + n, minlength=words + 1)
    return np.cumsum(edges)[:words] > 0


def repetition(ids: np.ndarray, sizes: np.ndarray) -> tuple[int, list[float]]:
    """Words in 3-word windows found twice or more; per length the share of characters in n-grams that occurred before."""
    words, total = len(ids), max(1, int(sizes.sum()))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    rolling, starts = mixed, np.arange(words)
    repeat_words, shares = 0, []
    if words < REPEAT_WINDOW:
        return 0, [0.0] * len(LENGTHS)
    for n in range(2, max(LENGTHS) + 1):
        # A longer window adds its last word; it can be a repeat only if the shorter ones inside are.
        inside = starts + n <= words
        rolling = rolling[inside] * BASE + mixed[starts[inside] + n - 1]
        starts = starts[inside]
        if n < REPEAT_WINDOW:
            continue
        twice, again = equal_windows(ids, rolling, starts, n)
        if n == REPEAT_WINDOW:
            repeat_words = int(covered(starts[twice], n, words).sum())
        if n in LENGTHS:
            shares.append(float(sizes[covered(starts[again], n, words)].sum()) / total)
        if not len(again) or not again.any():
            break
        rolling, starts = rolling[twice], starts[twice]
    shares += [0.0] * (len(LENGTHS) - len(shares))  # nothing longer is repeated
    return repeat_words, shares


def assess(text: bytes) -> tuple:
    """All figures of one text, in the order of ``SCHEMA`` without doc_id."""
    codes = np.frombuffer(text, np.uint8)
    inside = ~SEPARATOR[codes]
    letters = np.cumsum(inside & ((codes & 0xC0) != 0x80))  # code points in words so far
    steps = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) - 1
    sizes = letters[last] - letters[first] + 1 if len(first) else np.zeros(0, np.int64)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in text.split()), np.int64, len(first))
    repeat_words, shares = repetition(ids, sizes)

    before, dup, dup_chars = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in before:
                dup += 1
                dup_chars += sum(len(w.decode(errors="replace")) for w in line.split())
            before.add(line)
    words, chars = len(ids), int(sizes.sum())
    shares = [dup_chars / max(1, chars), *shares]
    failed = words < MIN_WORDS or 100 * repeat_words > REPEAT_PERCENT * words
    kept = not failed and all(share <= CHAR_LIMIT for share in shares)
    return (words, chars, int(np.count_nonzero(SYMBOL[codes])), dup, repeat_words, failed, kept, *shares)


def measure(docs: DataFrame) -> DataFrame:
    """One row of figures and the verdict ``kept`` per document; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [assess(t) for t in texts(batch.column("text"))]
            columns = list(zip(*rows)) or [()] * (len(fields) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, fields.types[1:]))], schema=fields)

    fields = pa.schema([(c.split()[0], {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[c.split()[1]]) for c in SCHEMA.split(", ")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


@with_any_names
def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):  # small copies
                part = batch.slice(start, SLICE_ROWS)
                yield part.filter(pa.array([assess(t)[6] for t in texts(part.column("text"))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
