"""Texts with bytes that are no UTF-8, and pieces without an end."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketry.llm import bpe, lines, quality
from basketry.llm.queries import RANKS

BROKEN = b"caf\xe9 \xff\xfe ok\n"


@pytest.fixture
def broken(spark):
    rows = [(1, BROKEN), (2, b"\xc3"), (3, b"plain"), (4, b"\xf0\x9f\x98"), (5, BROKEN * 30), (6, b" ".join(b"w%d" % i for i in range(80)))]
    df = spark.createDataFrame(rows, "doc_id long, raw binary")
    return df.select("doc_id", F.col("raw").cast("string").alias("text"))


def test_tokens_are_those_of_the_text_with_replacements(spark, broken):
    plain = [(1, BROKEN), (2, b"\xc3"), (3, b"plain"), (4, b"\xf0\x9f\x98")]
    fixed = spark.createDataFrame([(i, t.decode(errors="replace")) for i, t in plain], "doc_id long, text string")
    mine = sorted(map(tuple, bpe.digests(broken.filter("doc_id < 5"), RANKS, public_tokenizers.PATTERN).collect()))
    assert mine == sorted(map(tuple, bpe.digests(fixed, RANKS, public_tokenizers.PATTERN).collect()))
    assert mine[0][3] == hashlib.sha256(BROKEN.decode(errors="replace").encode()).hexdigest()
    spans = {r["doc_id"]: (r["starts"], r["ends"]) for r in bpe.encode(broken.filter("doc_id < 5"), RANKS, public_tokenizers.PATTERN).collect()}
    assert spans[1][1][-1] == len(BROKEN.decode(errors="replace"))


def test_quality_and_lines_go_on(broken):
    figures = {r["doc_id"]: r for r in quality.measure(broken).collect()}
    assert len(figures) == 6 and figures[5]["n_dup_lines"] == 29 and not figures[5]["kept"] and figures[6]["kept"]
    assert {r["doc_id"] for r in quality.keep(broken).collect()} == {6}
    assert lines.report(broken).count() == 6
    # The lines of document 5 are one line of document 1 thirty times; all but its first copies of 50 words go.
    short = {r["doc_id"]: bytes(r["raw"]) for r in lines.without_repeats(broken).select("doc_id", F.col("text").cast("binary").alias("raw")).collect()}
    assert len(short) == 6 and short[1] == BROKEN and short[2] == b"\xc3" and len(short[5]) < len(BROKEN) * 30 and not (short[5] + b"\n").replace(BROKEN, b"").strip()


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_CHARS", 1000)
    codec = bpe.Codec(bpe.build(bpe.read_ranks(RANKS), public_tokenizers.PATTERN), public_tokenizers.PATTERN)
    text = "".join(f" {chr(97 + i % 26) * 300}" for i in range(60))
    want = bpe.Codec(codec.json, public_tokenizers.PATTERN).whole.encode(text, add_special_tokens=False).ids
    assert [k for word in text.split(" ")[1:] for k in codec.ids(" " + word)] == want
    assert sum(map(len, codec.known)) <= 1400
