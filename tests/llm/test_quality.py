import re
from collections import Counter

from basketry.llm import quality
from tests.llm.conftest import AWKWARD, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    three = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if three[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, WORD.findall(line)))
            seen.add(line)
    chars, shares = sum(map(len, words)), []
    for n in quality.LENGTHS:
        before, cover = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i:i + n])
            if gram in before:
                cover |= set(range(i, i + n))
            before.add(gram)
        shares.append(sum(len(words[i]) for i in cover) / max(1, chars))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    kept = not failed and dup_chars / max(1, chars) <= quality.CHAR_LIMIT and all(s <= quality.CHAR_LIMIT for s in shares)
    return len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed, kept


TEXTS = [prose(1, 200), prose(2, 60) + "\n" + prose(2, 60), "a b c " * 40, prose(3, 80) + " " + " ".join(prose(3, 80).split()[:30]), "# $ é * " * 9,
         "line one here\n" * 30 + prose(4, 100), prose(5, 49), prose(5, 50), prose(6, 100) + "\n" + "\n".join([prose(7, 12)] * 4)]


def test_measures_match_brute_force(docs, spark, small):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + AWKWARD
    want = Counter((r[0], *brute(r[1])) for r in rows)
    assert Counter(tuple(r)[:8] for r in quality.measure(docs(rows)).collect()) == want
    table = spark.read.parquet(f"{small}/documents.parquet")
    want = {r["doc_id"]: brute(r["text"]) for r in table.collect()}
    assert {r["doc_id"]: tuple(r)[1:8] for r in quality.measure(table).collect()} == want


def test_hashes_that_collide_are_told_apart():
    import numpy as np
    ids, starts = np.array([1, 2, 3, 1, 2, 4]), np.arange(5)
    twice, again = quality.equal_windows(ids, np.zeros(5, np.uint64), starts, 2)
    assert twice.tolist() == [True, False, False, True, False] and again.tolist() == [False, False, False, True, False]


def test_keep_passes_rows_through(awkward, docs, empty):
    assert quality.keep(awkward).count() == 0 and quality.keep(awkward).columns == awkward.columns
    good = docs([(1, prose(1, 200), "en", "s", 7), (2, "a b " * 90, "en", "s", 7)], ("kept",))
    assert [tuple(r) for r in quality.keep(good).collect()] == [(1, prose(1, 200), "en", "s", 7, 0)]
    assert quality.keep(empty).count() == quality.measure(empty).count() == 0
