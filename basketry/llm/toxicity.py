"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A text is the bag of the byte n-grams of its words, each word between marks for its
beginning and end, so a misspelled word shares most of its vectors with the word
meant. Every n-gram has a vector by its hash; a text's vectors are averaged and a
linear softmax over two classes reads the average. Vectors and softmax are learned
together by gradient steps on the driver, from a bounded sample of labelled texts.

After training a vector acts on the score only through its product with the softmax
weights, so scoring reads one number per hash bucket (a table of fixed size) and
averages it over whole texts.

Labels are learned only from documents outside the held-out fold (crc32 of doc_id as
text, modulo ``FOLDS``, is 0); ids, languages and sources are no inputs. A null or
empty text has the average of no n-grams, the class prior's score; bytes that are no
UTF-8 count as U+FFFD. Labels other than 0
and 1 are ignored; without both classes in the sample every score is 0.5 or the prior.
A null doc_id is never labelled, ``held_out`` is false for it. Rows that repeat a
doc_id in the labels count once with their largest label. Repeated documents are scored
each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.common import texts

FOLDS = 5
# The bound of the training sample: documents of each class, and the longest text used to learn from.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1500, 20000
LENGTHS = (3, 4, 5, 6)
BUCKET_BITS = 18
DIMENSIONS, PASSES, BATCH, RATE = 8, 12, 32, 0.3
CHUNK = 1 << 20
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def ngrams(words: list[bytes]) -> np.ndarray:
    """Hash buckets of all n-grams of the words, repeats included."""
    if not words:
        return np.zeros(0, np.int64)
    number = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 2)
    return _buckets(b"".join(b"\x02%b\x03" % w for w in words), number)


def ngrams_of(text: bytes) -> Iterator[np.ndarray]:
    """``ngrams`` of the lower-cased words of a text, in arrays of bounded size; a word of over ``CHUNK`` bytes is cut, its n-grams are not."""
    text = text.decode(errors="replace").lower().encode()
    if len(text) <= CHUNK:
        yield ngrams(text.split())
        return
    held, size = [], 0
    for word in (m.group() for m in WORDS.finditer(text)):
        if len(word) > CHUNK:
            word = b"\x02%b\x03" % word
            for start in range(0, len(word), CHUNK):
                part = word[start:start + CHUNK + max(LENGTHS) - 1]
                yield _buckets(part, np.zeros(len(part), np.int64), CHUNK)
            continue
        held.append(word)
        size += len(word) + 2
        if size > CHUNK:
            yield ngrams(held)
            held, size = [], 0
    yield ngrams(held)


def _buckets(marked: bytes, number: np.ndarray, begin: int | None = None) -> np.ndarray:
    """Of the n-grams inside one word, ``number`` being that of each byte's word; with ``begin`` those that start before that byte."""
    marked = np.frombuffer(marked, np.uint8).astype(np.uint64)
    rolling, found = marked + np.uint64(1), [np.zeros(0, np.int64)]
    for n in range(2, max(LENGTHS) + 1):
        if len(marked) < n:
            break
        rolling = rolling[:-1] * np.uint64(0x100000001B3) + marked[n - 1:] + np.uint64(1)
        if n in LENGTHS:
            own = rolling[:begin][(number[:len(rolling)] == number[n - 1:])[:begin]]
            own = (own ^ (own >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
            found.append((own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """What one n-gram of a bucket adds to the log odds, and the odds of a text without any."""

    weights: np.ndarray
    prior: float

    def score(self, text: bytes) -> float:
        total, count = 0.0, 0
        for found in ngrams_of(text):
            total += float(self.weights[found].sum(dtype=np.float64))
            count += len(found)
        return float(1 / (1 + np.exp(-np.clip(self.prior + total / max(1, count), -50, 50))))


def train(samples: list[tuple[bytes, int]], seed: int = 7) -> Model:
    """Embeddings and softmax from (text, label) pairs; both classes weigh the same."""
    labels = np.array([label for _, label in samples], np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -5, 5)))
    bags = []
    for text, _ in samples:
        buckets, counts = np.unique(np.concatenate(list(ngrams_of(text))), return_counts=True)
        bags.append((buckets.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    used = np.unique(np.concatenate([b for b, _ in bags]))
    bags = [(np.searchsorted(used, b).astype(np.int32), c) for b, c in bags]
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32)
    softmax, bias = random.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    steps = [np.full_like(vectors, 1e-8), np.full_like(softmax, 1e-8), np.full_like(bias, 1e-8)]
    weight = len(labels) / (2 * np.bincount(labels, minlength=2))
    for _ in range(PASSES):
        order = random.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            rows = order[start:start + BATCH]
            sizes = [len(bags[r][0]) for r in rows]
            index, share = np.concatenate([bags[r][0] for r in rows]), np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), sizes)
            mean = np.stack([np.bincount(owner, share * vectors[index, d], len(rows)) for d in range(DIMENSIONS)], axis=1)
            logits = mean @ softmax + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - np.eye(2)[labels[rows]]) * weight[labels[rows]][:, None] / len(rows)
            back = error @ softmax.T
            at, inverse = np.unique(index, return_inverse=True)
            slope = np.stack([np.bincount(inverse, share * back[owner, d], len(at)) for d in range(DIMENSIONS)], axis=1)
            for value, gradient, step, where in ((vectors, slope, steps[0], at), (softmax, mean.T @ error, steps[1], slice(None)), (bias, error.sum(axis=0), steps[2], slice(None))):
                step[where] += gradient**2
                value[where] -= RATE * gradient / np.sqrt(step[where])
    weights = np.zeros(1 << BUCKET_BITS, np.float32)
    weights[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list[tuple[bytes, int]]:
    """At most ``per_class`` labelled texts of each class from outside the held-out fold, the same ones on every run."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.filter(~held_out(F.col("id")))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(known.filter("toxic = 0").orderBy(*order).limit(per_class))
    short = docs.filter(F.length("text") <= SAMPLE_CHARS).select(F.col("doc_id").cast("long").alias("id"), "text")
    # At most 2 * per_class rows of two numbers.
    found = short.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    return [(r["text"].encode(), r["toxic"]) for r in sorted(found.collect(), key=lambda r: r["id"])]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    # Plain values: a broadcast names the classes of its objects, and executors need not have this library.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.prior))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = pa.array([own.score(t) for t in texts(batch.column("text"))], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), scores], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(sample(docs, labels)))
