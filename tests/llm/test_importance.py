import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from basketry.llm import importance
from tests.llm.conftest import AWKWARD, WORDS


def features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target):
    found = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
    scored = []
    for d, words, f in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        scored.append((d, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = 5 * len(able) // 100
    return [(*r, n + 1 if n < drawn else None) for n, r in enumerate(able)] + [(*r, None) for r in scored if r[1] < 20]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def texts(seed=2):
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choice(WORDS + ["Éà", "A-B", "x1", "中文", "1.5"]) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    return rows + [(4, "same words here " * 9)] * 150 + [(None, "same words here " * 9)] * 5 + [(400, None), (401, ""), (402, "y" * 5000), (403, " \x00\x7f;")]


@pytest.mark.parametrize("chunk", [1 << 20, 1, 30])
def test_matches_brute_force(docs, monkeypatch, chunk):
    monkeypatch.setattr(importance, "CHUNK", chunk)
    rows, target = texts(), ["alpha beta Éà gamma", "Beta x1 x1", None, ""]
    table = docs([(i, t, "en", "s", 0) for i, t in rows], ("score", "rank", "place", "_at"))
    got = importance.resample(table, docs([(i, t, None, None, None) for i, t in enumerate(target)])).collect()
    assert order(map(tuple, got)) == order(brute(rows, target))


def test_ranks_are_whole(docs):
    rows = texts(5)
    got = importance.resample(docs([(i, t, "en", "s", 0) for i, t in rows]), docs([]), percent=100)
    ranks = sorted(r["rank"] for r in got.collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == sum(features(t)[0] >= 20 for _, t in rows)


def test_awkward_rows(docs, awkward, empty):
    got = importance.resample(awkward, awkward).collect()
    assert order(map(tuple, got)) == order(brute([r[:2] for r in AWKWARD], [r[1] for r in AWKWARD]))
    assert importance.resample(empty, empty).count() == 0


def test_registered_query(spark, small):
    from basketry.llm import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = queries.QUERIES["op12_importance"](spark, small)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert order(map(tuple, got.collect())) == order((d, *r) for d, _, *r in brute(rows, target))
