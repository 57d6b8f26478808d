"""Near copies by ball hashing of SimHash words, verified by the Jaccard similarity of word shingles.

Texts with equal sets of ``SHINGLE_WORDS``-word shingles are one class. Each class has a SimHash fingerprint of ``WORDS``
words of ``WORD_BITS`` bits. A shingle votes on each bit with a byte of its own, so that a class of five shingles has as
many shades as one of thousands; a bit is set where the votes are above their mean, and its margin is how far they are
from it. Each class is stored at all points of the ball around each of its words that its ``UNSURE`` bits of least margin
span, 2^UNSURE points a word, and classes meet in the middle: two meet at a word if each bit they differ in is unsure in
one of them. Rows are shuffled on the point. Two classes with a similarity of 0.8 differ in 15 % of all bits, but these
are nearly always unsure ones: they meet at a given word with probability 0.245, at none of 36 with 0.00004.

A ball is emitted only for a class that may have a near copy: of its ``LEAST`` smallest shingles at least ``SHARED`` (or as large a
share, if it has fewer) are among the smallest of other classes. Two with a similarity of 0.8 have 25.6 of 32 in
common in the mean, fewer than 12 with probability 3e-8; and most texts of a corpus are like no other.

Points shared by more than one class are buckets. First each class is compared with the smallest and the largest class
of its buckets, at most once for every ``TOGETHER`` words, which joins a group of copies however large with a number of
comparisons that grows with its members. Then all pairs of a bucket that are not yet in one component are compared, so
no link between components is lost: buckets of up to ``FEW`` members by pairs; larger ones, merged into neighbourhoods where they
have members in common, in dense tiles of blocks of a neighbourhood, so that its pairs never become rows.
Pairs that differ in over ``FAR`` of ``PROBED`` words' bits met by chance and are dropped; the others are verified by
their exact similarity, and components are merged.

Shingles are compared as 64-bit hashes. Words are cut and lowered as in
``simhash.fingerprint``; a text of fewer words is one shingle, one without words has
none and is equal only to others like it. A null text is empty, a null doc_id an id of its
own that never stands for others. Repeated rows are one class. Of a component the row with
the smallest doc_id stays, among equals that with the smallest digest of its text. A text
of any length is read whole. An empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm.common import DOC, doc_key, texts, with_any_names, written
from basketry.llm.graph import components
from basketry.llm.simhash import one_of_each

SHINGLE_WORDS = 5
LEAST_TENTHS = 8  # the similarity from which two texts are near copies, in tenths
WORDS, WORD_BITS, UNSURE = 36, 28, 4
LEAST, SHARED = 32, 12
PROBED, FAR = 5, 48  # of 140 bits 21 differ in the mean at the limit, over 48 with probability 4e-9; 70 if two met by chance
TOGETHER, FEW = 4, 8
CHUNK, BLOCK, COLUMNS = 1 << 12, 256, 4096

BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
SLOTS = np.random.RandomState(42).randint(0, 1 << 63, WORDS * WORD_BITS // 8, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words_in_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(words_in_shingle, len(words))
    rolling = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        rolling = rolling * BASE + hashes[k:len(words) - n + 1 + k]
    return np.unique(mixed(rolling))


def class_of(found: np.ndarray) -> int:
    """A signed 64-bit digest of a set of shingles."""
    return xxhash.xxh64_intdigest(found.astype("<u8").tobytes()) - (1 << 63)


def words(found: np.ndarray) -> np.ndarray:
    """The words of the fingerprint of a set of shingles: the bits, and above them 5 bits for the place of each unsure one."""
    votes = np.zeros(WORDS * WORD_BITS, np.int64)
    for start in range(0, len(found), CHUNK):  # bounded memory for any length of text
        voted = mixed(found[start:start + CHUNK, None] * SLOTS[None])
        votes += voted.astype("<u8").view(np.uint8).sum(axis=0, dtype=np.int64)
    margin = (2 * votes - 255 * len(found)).reshape(WORDS, WORD_BITS)
    out = (margin > 0) @ (1 << np.arange(WORD_BITS, dtype=np.int64))
    unsure = np.argsort(np.abs(margin), axis=1, kind="stable")[:, :UNSURE]
    for k in range(UNSURE):
        out |= unsure[:, k] << (WORD_BITS + 5 * k)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """``DOC, cls, least`` per row."""
    fields = pa.schema([("_none", pa.bool_()), ("_id", pa.int64()), ("_text", pa.int64()), ("cls", pa.int64()), ("least", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, least = [], []
            for text in texts(batch.column("text")):
                found = shingles(text)
                classes.append(class_of(found))
                least.append(found[:LEAST].view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in DOC), pa.array(classes, pa.int64()), pa.array(least, pa.list_(pa.int64()))], schema=fields)

    return docs.select(*doc_key(docs), "text").mapInArrow(run, "_none boolean, _id long, _text long, cls long, least array<long>")


def not_alone(rows: DataFrame) -> DataFrame:
    """``cls``: the classes that may have a near copy, as others have enough of their smallest shingles."""
    held = rows.select("cls", F.size("least").alias("of"), F.explode("least").alias("shingle")).distinct()
    # As a table of its own it lets Spark split the join where very many have a shingle.
    common = written(held.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle"), "common-shingles")
    shared = held.join(common, "shingle", "left_semi").groupBy("cls", "of").agg(F.count("*").alias("n"))
    return shared.filter(LEAST * F.col("n") >= SHARED * F.col("of")).select("cls")


def fingerprints(sets: DataFrame) -> DataFrame:
    """``cls, words`` per class of ``sets``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found")
            out = [words(found[i].values.to_numpy().view(np.uint64)) for i in range(len(found))]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(out, pa.list_(pa.int64()))], names=["cls", "words"])

    return sets.mapInArrow(run, "cls long, words array<long>")


def balls(prints: DataFrame, *more: str) -> DataFrame:
    """``cls, point`` and the columns ``more``: the points of the balls around the words of each class; the number of a word is part of its points."""
    # Each row becomes 576: they are dealt to as many tasks as a shuffle has before they grow.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    word = prints.repartition(parts, F.xxhash64("cls")).select("cls", *more, F.posexplode("words").alias("no", "word"))
    points = [F.col("word").bitwiseAND((1 << WORD_BITS) - 1) + F.col("no").cast("long") * (1 << WORD_BITS)]
    for k in range(UNSURE):
        place = F.shiftright("word", WORD_BITS + 5 * k).bitwiseAND(31).cast("int")
        points += [p.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), place)) for p in points]
    return word.select("cls", *more, F.explode(F.array(*points)).alias("point"))


def members(prints: DataFrame) -> DataFrame:
    """``point, cls, low, high``: the classes in each bucket that has more than one, with its smallest and largest."""
    at = Window.partitionBy("point")
    return balls(prints).select("point", "cls", F.min("cls").over(at).alias("low"), F.max("cls").over(at).alias("high")).filter("low < high")


def first_candidates(met: DataFrame) -> DataFrame:
    """``a, b``: pairs of classes, a < b: each with the smallest and the largest class that it meets in a few words."""
    no = F.floor(F.shiftright("point", WORD_BITS) / TOGETHER)
    ends = met.groupBy("cls", no.alias("no")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = ends.select("cls", F.explode(F.array("low", "high")).alias("end")).filter("cls <> end")
    return pairs.select(F.least("cls", "end").alias("a"), F.greatest("cls", "end").alias("b")).distinct()


def several(classes: DataFrame, *more: str) -> DataFrame:
    """``point, cls, root, n, low`` and the columns ``more``: the members of buckets of several components, their number and the smallest."""
    at = Window.partitionBy("point")
    ends = [F.count("*").over(at).alias("n"), F.min("cls").over(at).alias("low"), F.min("root").over(at).alias("_l"), F.max("root").over(at).alias("_h")]
    return balls(classes, "root", *more).select("point", "cls", "root", *more, *ends).filter("_l < _h").drop("_l", "_h")


def other_links(roots: DataFrame, prints: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: verified links that join components whose classes meet in a bucket.

    Large buckets with a member in common are a neighbourhood. Its members are dealt to blocks of about ``block``. Every
    two blocks are a tile, compared in one task; it returns the few links that are needed to join what belongs together
    in it, so its pairs never become rows. In small buckets all pairs are compared that are in no neighbourhood together.
    """
    rooted = prints.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    large = several(rooted).filter(F.col("n") > FEW).select("cls", "low").distinct()
    # One link a class, to its smallest; the others lie between the smallest of buckets, which are few.
    ends = large.withColumn("b", F.min("low").over(Window.partitionBy("cls"))).select("b", F.explode(F.array("cls", "low")).alias("a")).distinct()
    near = written(components(ends).select(F.col("node").alias("cls"), F.col("root").alias("near")), "neighbourhoods")
    parts = near.groupBy("near").agg(F.ceil(F.count("*") / block).cast("int").alias("of"))
    placed = rooted.drop("words").join(near, "cls").join(written(parts, "parts"), "near").withColumn("no", F.pmod(F.xxhash64("cls"), F.col("of")).cast("int"))
    laid = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).select(
        "near", "cls", "root", "no", F.least("no", "other").alias("i"), F.greatest("no", "other").alias("j"))
    found = laid.join(sets, "cls").groupBy("near", "i", "j").applyInArrow(joining, "a long, b long")

    small = several(rooted.join(near, "cls", "left").withColumn("near", F.coalesce("near", "cls")), "near").filter(F.col("n") <= FEW)
    held = small.groupBy("point").agg(F.collect_list(F.struct("cls", "root", "near")).alias("held"))
    unlike = lambda x, y: (x["cls"] < y["cls"]) & (x["root"] != y["root"]) & (x["near"] != y["near"])
    pairs = held.select(F.explode(F.flatten(F.transform("held", lambda x: F.transform(
        F.filter("held", lambda y: unlike(x, y)), lambda y: F.struct(x["cls"].alias("a"), y["cls"].alias("b")))))).alias("p"))
    return found.unionByName(verified(pairs.select("p.a", "p.b").distinct(), prints, sets)).distinct()


def joining(tile: pa.Table) -> pa.Table:
    """Links between classes of different components of a tile, one for each two that they join."""
    root, cls, no = (tile.column(c).to_numpy() for c in ("root", "cls", "no"))
    lists = tile.column("found").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(cls)), sizes)
    _, value, held = np.unique(values, return_inverse=True, return_counts=True)
    shared = held[value] > 1  # only these can be common to two
    value, owner = np.unique(value[shared], return_inverse=True)[1], owner[shared]
    both = np.zeros((len(cls), len(cls)), np.float32)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    for start in range(0, int(value.max(initial=-1)) + 1, COLUMNS):
        own = slice(*np.searchsorted(value, [start, start + COLUMNS]))
        has = np.zeros((len(cls), COLUMNS), np.float32)
        has[owner[own], value[own] - start] = 1
        both += has @ has.T
    common = both.astype(np.int64)
    like = 10 * common >= LEAST_TENTHS * (sizes[:, None] + sizes[None] - common)
    like &= root[:, None] != root[None]
    if no.min() != no.max():
        like &= no[:, None] != no[None]  # pairs within a block have a tile of their own
    above: dict[int, int] = {}

    def top(node: int) -> int:
        while node in above:
            node = above[node]
        return node

    out = []
    for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(like)))):
        r, s = top(int(root[x])), top(int(root[y]))
        if r != s:
            above[max(r, s)] = min(r, s)
            out.append((min(cls[x], cls[y]), max(cls[x], cls[y])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def shingle_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, found``: the shingles of each class in ``wanted`` (column ``cls``), from one of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t).view(np.int64) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(found, pa.list_(pa.int64()))], names=["cls", "found"])

    one = rows.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("_text").alias("_text"))
    one = written(one, "class-texts")
    keyed = docs.select(F.coalesce(F.xxhash64(docs["text"]), F.lit(0)).alias("_text"), "text")
    return keyed.join(one, "_text").mapInArrow(run, "cls long, found array<long>").dropDuplicates(["cls"])


def verified(pairs: DataFrame, prints: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose similarity reaches the limit."""
    x, y = (prints.select(F.col("cls").alias(c), F.slice("words", 1, PROBED).alias(f"_{c}")) for c in "ab")
    differ = F.zip_with("_a", "_b", lambda v, w: F.bit_count(v.bitwiseXOR(w).bitwiseAND((1 << WORD_BITS) - 1)))
    near = pairs.join(x, "a").join(y, "b").filter(F.aggregate(differ, F.lit(0), lambda n, d: n + d) <= FAR).select("a", "b")
    # As a table of its own it lets Spark measure the joins with the sets.
    near = written(near, "near-pairs")
    left, right = sets.select(F.col("cls").alias("a"), F.col("found").alias("_x")), sets.select(F.col("cls").alias("b"), F.col("found").alias("_y"))
    both = near.join(left, "a").join(right, "b").withColumn("_both", F.size(F.array_intersect("_x", "_y")))
    return both.filter(10 * F.col("_both") >= LEAST_TENTHS * (F.size("_x") + F.size("_y") - F.col("_both"))).select("a", "b")


def linked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``node, root`` of the classes that have a link."""
    sets = written(shingle_sets(docs, rows, not_alone(rows)), "shingle-sets")
    prints = written(fingerprints(sets), "fingerprints")
    met = written(members(prints), "bucket-members")
    first = written(verified(first_candidates(met), prints, sets), "links")
    roots = written(components(first), "roots")
    more = written(other_links(roots, prints, sets), "links")
    return components(first.unionByName(more)) if more.limit(1).count() else roots


@with_any_names
def keep_one(docs: DataFrame) -> DataFrame:
    """The first document, by doc_id, of each component of near copies with all its columns; see ``simhash.one_of_each``."""
    rows = written(sketches(docs), "sketches")
    return one_of_each(docs, rows.select(*DOC, "cls"), "cls", linked(docs, rows))
