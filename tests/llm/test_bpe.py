import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from basketry.llm import bpe
from basketry.llm.queries import RANKS
from tests.llm.conftest import AWKWARD


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.build(bpe.read_ranks(RANKS), public_tokenizers.PATTERN), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_match_another_library(codec, other):
    rnd = random.Random(5)
    units = ["a", "ab", " ", "\n", "=", "-", "0", "é", "中", "'s", "'re", "'", "_", "\t", "\U0001f600", "́", "б", " ", " ", "\x1c", "\x85", "᫟", "\U0003f044"]
    for _ in range(3000):
        text = "".join(rnd.choice(units) * rnd.choice([1, 1, 2, 3, rnd.randint(1, 50)]) for _ in range(rnd.randint(0, 25)))
        ids = codec.ids(text)
        assert ids == other.encode_ordinary(text), text
        assert codec.decode(ids) == text and len(codec.offsets(text)) == len(ids)


def test_long_texts_are_cut_where_the_pattern_cuts(codec, other, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 40)
    rnd = random.Random(6)
    for _ in range(300):
        text = "".join(rnd.choice(["word", " ", "  ", ", ", "\n", "don't", "'s ", "12", "é", ". ", "\t", "x"]) for _ in range(400))
        assert "".join(bpe.parts(text, 40)) == text
        assert codec.ids(text) == other.encode_ordinary(text)


def test_offsets_and_split_characters(codec):
    text = "naïve \U0001f9ff café"
    ids, spans = codec.ids(text), codec.offsets(text)
    assert all(codec.bytes[i] in text[a:b].encode() for i, (a, b) in zip(ids, spans))
    half = codec.ids("\U0001f9ff")
    assert len(half) > 1 and codec.decode(half) == "\U0001f9ff" and codec.decode(half[:1]).endswith("�")


def test_queries_over_tables(spark, docs, awkward, empty, other, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    for df in (table, awkward):
        want = []
        for r in df.collect():
            ids = other.encode_ordinary(r["text"] or "")
            want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
        assert sorted(map(tuple, bpe.digests(df, RANKS, public_tokenizers.PATTERN).collect()), key=str) == sorted(want, key=str)
    tokens = bpe.encode(awkward, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(tokens, RANKS, public_tokenizers.PATTERN)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((r[0], r[1] or "") for r in AWKWARD), key=str)
    assert bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
