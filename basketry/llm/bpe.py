"""Byte-level BPE: encoding with the ``tokenizers`` library, decoding with the byte table.

A vocabulary is a file of ranks (base64 of the token's bytes, then its id). Text
is cut by a pattern, each piece becomes one character per UTF-8 byte, and
neighbouring tokens are merged in the order of the ids. Decoding reads a
token's characters back as bytes; a character whose bytes lie in several tokens
is whole again once they are joined, and what is left incomplete at an end
becomes U+FFFD.

Texts of any length are encoded in parts that end where the pattern must cut,
so memory is bounded by ``PART`` characters unless a text has no such place.
Nulls: a null text is an empty one and has no tokens. Bytes that are no UTF-8 count
as U+FFFD. Repeated rows are encoded each; an empty table gives no rows; extra
columns are ignored. Ties do not occur: no two tokens have the same rank.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from basketry.llm.common import texts

PART = 1 << 15
REMEMBERED, REMEMBERED_CHARS = 1 << 17, 1 << 22
# Characters whose classes no version of Unicode has changed; other texts are cut by the tokenizer's own pattern engine.
SETTLED = re.compile("[\x00-\u024f\u0410-\u044f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u3001-\u3003\u4e00-\u9fa5\uac00-\ud7a3]*")
# The pattern never crosses the end of a run of letters.
RUN_END = re.compile(r"[^\W\d_](?=[\s.,;:!?])")


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer as JSON. Any two tokens whose bytes make a third may merge, at the rank of the third."""
    chars = byte_chars()
    word = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [(word[token[:cut]], word[token[cut:]]) for token in sorted(ranks, key=ranks.get)
              for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks]
    tokenizer = Tokenizer(models.BPE(vocab={word[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer.to_str()


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` cut behind letters before white space or punctuation, into parts of about ``size`` characters."""
    start = 0
    while len(text) - start > size and (end := RUN_END.search(text, start + size)):
        yield text[start:end.end()]
        start = end.end()
    yield text[start:]


class Codec:
    """A tokenizer with its byte table. Pieces of text met before are not encoded again; the bounds of what is kept are ``REMEMBERED`` pieces and ``REMEMBERED_CHARS`` characters, and one part."""

    def __init__(self, json: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core; threads of its own only get in the way
        self.json, self.tokenizer = json, Tokenizer.from_str(json)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces, self.known, self.held = regex.compile(pattern).findall, {}, 0
        back = {c: b for b, c in enumerate(byte_chars())}
        vocab = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, key in vocab.items():
            self.bytes[key] = bytes(back[c] for c in token)
        self.shared = list(range(len(self.bytes)))  # one number object per id, whatever is remembered

    @cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer with its own pattern; most workers never need it."""
        return Tokenizer.from_str(self.json)

    def ids(self, text: str) -> list[int]:
        found: list[int] = []
        for part in parts(text):
            if not (part.isascii() or SETTLED.fullmatch(part)):
                found.extend(self.whole.encode(part, add_special_tokens=False).ids)
                continue
            pieces = self.pieces(part)
            new = list({p for p in pieces if p not in self.known})
            if len(self.known) > REMEMBERED or self.held > REMEMBERED_CHARS:
                self.known, self.held, new = {}, 0, list(set(pieces))
            self.held += sum(map(len, new))
            for piece, code in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False) if new else ()):
                self.known[piece] = tuple(map(self.shared.__getitem__, code.ids))
            found.extend(chain.from_iterable(map(self.known.__getitem__, pieces)))
        return found

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """First and last code point (exclusive) that each token has a byte of."""
        found, before = [], 0
        for part in parts(text):
            found += [(a + before, b + before) for a, b in self.whole.encode(part, add_special_tokens=False).offsets]
            before += len(part)
        return found

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.joined(ids).decode("utf-8", "replace")


def _codec(docs: DataFrame, path: str, pattern: str):
    """A broadcast of the tokenizer: its size is that of the vocabulary file, whatever the documents."""
    return docs.sparkSession.sparkContext.broadcast(build(read_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, starts, ends`` per document: token ids with their character offsets."""
    json = _codec(docs, path, pattern)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("ids", "starts", "ends"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(json.value, pattern)
        for batch in batches:
            for row, text in enumerate(texts(batch.column("text"))):
                text = text.decode(errors="replace")
                spans = codec.offsets(text)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, 1), *(
                    pa.array([v], pa.list_(pa.int32())) for v in (codec.ids(text), [a for a, _ in spans], [b for _, b in spans]))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""
    json = _codec(tokens, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(json.value, pattern)
        for batch in batches:
            out = [codec.decode(ids.as_py() or []) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document: encoded, decoded again, and both digested in one pass."""
    json = _codec(docs, path, pattern)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(json.value, pattern)
        decimal = list(map(str, range(len(codec.bytes))))
        for batch in batches:
            rows = []
            for text in texts(batch.column("text")):
                ids = codec.ids(text.decode(errors="replace"))
                listed = ",".join(map(decimal.__getitem__, ids)).encode()
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(codec.joined(ids)).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(
                pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 3, schema.types[1:]))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
