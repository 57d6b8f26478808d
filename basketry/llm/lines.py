"""Line dedup: later copies of repeated runs of lines are deleted.

The documents are one sequence of line ids. Prefix doubling sorts its suffixes:
after each step a suffix's rank is its place by the first 1, 2, 4, ... lines.
Suffixes with a common prefix of L lines form one longest-common-prefix interval
of that order; two overlapping ranks of a power of two name it exactly. The
first suffix of an interval (by doc_id, then place) is the first copy, all
others start a later copy.

A line is deleted if it lies in a run of lines that together hold at least
``MIN_WORDS`` words and that occurs earlier, in the same or another document.
A repeated run is the union of its shortest parts of that many words that begin
or end at each of its lines, so only intervals of those lengths are looked up
and doubling stops when the longest of them is ranked.

What keeps it small: lines that occur once end every common prefix, so only
stretches of repeated lines with enough words are sorted at all. Distinct pairs
of ranks are counted before they are sorted; a very common line is one row
there. Each step is a table in the shared folder.

Lines without a word take no part and go with the line before them. A null or
empty text has no lines; a text is split on its own, so a very long one takes
memory in proportion to its lines. Bytes that are no UTF-8 stay as they
are. An empty table gives no rows. Rows that repeat a doc_id with the same text are one
document and get the same result; the same doc_id with another text is another
document. Rows without doc_id come last. Extra columns are ignored by
``report`` and passed through by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from basketry.llm.common import DOC, doc_key, fresh, texts, with_any_names, written

MIN_WORDS = 50
BATCH_LINES, SLICE_ROWS = 50000, 500


def split_lines(docs: DataFrame) -> DataFrame:
    """``DOC, place, line_no, until, words, digest`` of each line with a word.

    ``place`` counts those lines only, ``line_no`` all, from 0; the lines before ``until`` have no word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], tuple([] for _ in fields.types[3:])
            for row, text in enumerate(texts(batch.column("text"))):
                lines = text.split(b"\n")
                counts = [len(line.split()) for line in lines]
                real = [i for i, n in enumerate(counts) if n]
                rows += [row] * len(real)
                for column, values in zip(columns, (range(len(real)), real, [*real[1:], len(lines)] if real else (), [counts[i] for i in real],
                                                    [hashlib.md5(lines[i]).digest() for i in real])):
                    column.extend(values)
                if len(rows) > BATCH_LINES:
                    yield packed(batch, rows, columns)
                    rows, columns = [], tuple([] for _ in columns)
            yield packed(batch, rows, columns)

    def packed(batch: pa.RecordBatch, rows: list, columns: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows, pa.int64())) for c in DOC),
                                           *(pa.array(c, k) for c, k in zip(columns, fields.types[3:]))], schema=fields)

    ints = ("place", "line_no", "until", "words")
    fields = pa.schema([("_none", pa.bool_()), ("_id", pa.int64()), ("_text", pa.int64()), *((c, pa.int32()) for c in ints), ("digest", pa.binary())])
    return docs.select(*doc_key(docs), "text").mapInArrow(
        run, f"_none boolean, _id long, _text long, {', '.join(c + ' int' for c in ints)}, digest binary")


def suffix_ranks(lines: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, int]:
    """Stretches of repeated lines with ranks ``r0, r1, ...`` of each suffix by its first 1, 2, 4, ... lines, and the number of steps.

    Columns: DOC, stretch, place, line_no, until, words, r0, r1, ...; a suffix that ends before the prefix is full sorts first.
    """
    again = lines.groupBy("digest").count().filter("count > 1").select("digest")
    first = written(_ordered(again, ["digest"], "r0"), "line-ranks")
    here = Window.partitionBy(*DOC).orderBy("place")
    # Rows that repeat a document count once: each place has one line.
    active = lines.join(first, "digest").drop("digest").dropDuplicates([*DOC, "place"])
    active = active.withColumn("stretch", F.col("place") - F.row_number().over(here))
    stretch = Window.partitionBy(*DOC, "stretch")
    active = active.withColumn("_all", F.sum("words").over(stretch)).filter(F.col("_all") >= min_words).drop("_all")
    active = written(active, "suffixes")
    steps, most = 0, _longest_window(active, min_words)
    following = Window.partitionBy(*DOC, "stretch").orderBy("place")
    while 2 << steps <= most:
        old, new = f"r{steps}", f"r{steps + 1}"
        pairs = active.withColumn("_next", F.coalesce(F.lead(old, 1 << steps).over(following), F.lit(-1)))
        ranks = written(_ordered(pairs.groupBy(old, "_next").count().drop("count"), [old, "_next"], new), "pair-ranks")
        active = written(pairs.join(ranks, [old, "_next"]).drop("_next"), "suffixes")
        steps += 1
    return active, steps


def _ordered(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Ranks in the order of the distinct ``keys``: ascending over the sorted partitions, not gapless."""
    return distinct.orderBy(*keys).withColumn(name, F.monotonically_increasing_id())


def windows(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First lines and lengths of the shortest parts with ``min_words`` words that begin, or end, at each line of a stretch."""
    sums = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    ends = np.searchsorted(sums, sums[:-1] + min_words)  # exclusive; n + 1 if there are too few words
    begins = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1  # -1 if there are too few words
    first, last = np.flatnonzero(ends <= n), np.flatnonzero(begins >= 0)
    found = np.unique(np.concatenate([first << 32 | (ends[first] - first), begins[last] << 32 | (last + 1 - begins[last])]))
    return found >> 32, found & 0xFFFFFFFF


def _longest_window(active: DataFrame, min_words: int) -> int:
    """Most lines in any window: every line has a word, so at most ``min_words``, and usually far fewer."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"n": [windows(np.asarray(w, np.int64), min_words)[1].max(initial=0) for w in rows["words"]]})

    stretches = active.groupBy(*DOC, "stretch").agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("l")).select(F.col("l.words").alias("words"))
    return stretches.mapInPandas(run, "n int").agg(F.max("n")).first()[0] or 0


def later_copies(active: DataFrame, steps: int, min_words: int = MIN_WORDS) -> DataFrame:
    """``DOC, place, length``: runs that occur earlier, as windows of lines."""
    names = [f"r{k}" for k in range(steps + 1)]
    stretches = active.groupBy(*DOC, "stretch").agg(F.sort_array(F.collect_list(F.struct("place", "words", *names))).alias("l"))
    columns = [F.col(f"l.{c}").alias(c) for c in ("place", "words", *names)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            parts: list[list[np.ndarray]] = [[] for _ in found]
            for row, (place, words, *ranks) in enumerate(zip(*(rows[c] for c in ("place", "words", *names)))):
                first, length = windows(np.asarray(words, np.int64), min_words)
                level = np.frexp(length)[1] - 1  # 2^level <= length
                table = np.stack(ranks)
                for part, values in zip(parts, (np.full(len(first), row), length, table[level, first], table[level, first + length - (1 << level)], np.asarray(place)[first])):
                    part.append(values)
            row, *columns = (np.concatenate([np.zeros(0, np.int64), *part]) for part in parts)
            yield pd.DataFrame({**{c: rows[c].to_numpy()[row] for c in DOC}, **dict(zip(found[1:], columns))})

    found = ("row", "length", "head", "tail", "place")
    # An interval: the suffixes whose first `length` lines are equal, named by the ranks of two overlapping parts.
    interval = ["length", "head", "tail"]
    starts = written(stretches.select(*DOC, *columns).mapInPandas(
        run, "_none boolean, _id long, _text long, length int, head long, tail long, place int"), "windows")
    first = starts.groupBy(*interval).agg(F.count("*").alias("n"), F.min(F.struct(*DOC, "place")).alias("first")).filter("n > 1").drop("n")
    # As a table of its own it lets Spark split the join where one interval has very many copies.
    first = written(first, "first-copies")
    return starts.join(first, interval).filter(F.struct(*DOC, "place") > F.col("first")).select(*DOC, "place", "length")


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``DOC, gone``: per document that loses lines, the sorted numbers (from 0) of those with a word."""
    lines = written(split_lines(docs), "lines")
    active, steps = suffix_ranks(lines, min_words)
    runs = later_copies(active, steps, min_words)
    # The longest run from each place covers the shorter ones.
    runs = runs.groupBy(*DOC, "place").agg(F.max("length").alias("length"))
    covered = runs.select(*DOC, F.explode(F.sequence(F.col("place"), F.col("place") + F.col("length") - 1)).alias("place")).distinct()
    spans = covered.join(active.select(*DOC, "place", "line_no", "until"), [*DOC, "place"])
    return spans.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("line_no", "until"))).alias("gone"))


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_lines, n_deleted, deleted, kept_sha256`` per document: see ``summary``."""
    return _with_gone(docs, min_words, summary, "doc_id long, n_lines long, n_deleted long, deleted string, kept_sha256 string")


@with_any_names
def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later copies of runs, all columns kept; a document that loses its last line is dropped.

    ``n_chars``, where there is such a column, follows a text that changed.
    """
    return _with_gone(docs, min_words, shorten, docs.schema)


def _with_gone(docs: DataFrame, min_words: int, work: Callable, schema: T.StructType | str) -> DataFrame:
    """``work`` over batches of the documents' columns and, per row, the pairs (first, until) of deleted lines or none."""
    key = [fresh(docs, c) for c in DOC]
    gone, n = fresh(docs, "gone"), len(docs.columns)
    lost = deletions(docs, min_words).select(*(F.col(c).alias(k) for c, k in zip(DOC, key)), F.col("gone").alias(gone))
    named = docs.select("*", *(c.alias(k) for c, k in zip(doc_key(docs), key)))
    joined = named.join(lost, key, "left").select(*docs.columns, F.col(f"{gone}.line_no"), F.col(f"{gone}.until"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                spans = [None if a is None else list(zip(a, b)) for a, b in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist())]
                yield work(pa.RecordBatch.from_arrays(part.columns[:n], names=part.schema.names[:n]), spans)

    return joined.mapInArrow(run, schema)


def shorten(batch: pa.RecordBatch, spans: list) -> pa.RecordBatch:
    """The batch with shortened texts and their new ``n_chars``, without the rows that have no word left."""
    if not any(spans):
        return batch
    columns = dict(zip(batch.schema.names, batch.columns))
    short = {i: cut(t, gone) for i, (t, gone) in enumerate(zip(texts(columns["text"]), spans)) if gone}
    # Texts as bytes: those that are no UTF-8 pass as they are.
    raw = pa.large_binary() if pa.types.is_large_string(columns["text"].type) else pa.binary()
    for name, kind, of in (("text", raw, bytes), ("n_chars", None, lambda t: len(t.decode(errors="replace")))):
        if name in columns:
            values = columns[name].cast(kind or columns[name].type).to_pylist()
            for i, text in short.items():
                values[i] = of(text)
            columns[name] = pa.array(values, kind or columns[name].type).view(columns[name].type)
    keep = pa.array([i not in short or bool(short[i].split()) for i in range(len(spans))])
    return pa.RecordBatch.from_arrays(list(columns.values()), names=batch.schema.names).filter(keep)


def summary(batch: pa.RecordBatch, spans: list) -> pa.RecordBatch:
    """Per document the number of its lines with a word, of those deleted, their spans ``first:until`` and a digest of what stays."""
    rows = []
    for text, gone in zip(texts(batch.column("text")), spans):
        real = [bool(line.split()) for line in text.split(b"\n")]
        lost = sum(sum(real[a:b]) for a, b in gone or ())
        rows.append((sum(real), lost, ",".join(f"{a}:{b}" for a, b in gone or ()), hashlib.sha256(cut(text, gone or [])).hexdigest()))
    columns = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(
        pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string())))],
        names=["doc_id", "n_lines", "n_deleted", "deleted", "kept_sha256"])


def cut(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    """``text`` without the lines from the first to before the second number of each pair."""
    lines = text.split(b"\n")
    for first, until in reversed(gone):
        del lines[first:until]
    return b"\n".join(lines)
