import random

import pytest

from basketry.llm import lines
from tests.llm.conftest import AWKWARD, prose


def brute(rows, least):
    """Deleted line numbers per (doc_id, text): every line in a run of enough words that occurs earlier."""
    distinct = sorted({(d is None, d or 0, t or "") for d, t in rows})
    # Equal ids with different texts are ordered by a digest; the tests avoid them.
    sequence, owner = [], []
    for key in distinct:
        for n, line in enumerate(key[2].split("\n")):
            if line.encode().split():
                sequence.append(line)
                owner.append((key, n))
        sequence.append(object())
        owner.append((key, None))
    gone = {key: set() for key in distinct}
    for i in range(len(sequence)):
        for j in range(i):
            k = 0
            while i + k < len(sequence) and sequence[i + k] == sequence[j + k] and isinstance(sequence[i + k], str):
                k += 1
            if k and sum(len(x.encode().split()) for x in sequence[i:i + k]) >= least:
                gone[owner[i][0]] |= {owner[i + m][1] for m in range(k)}
    out = {}
    for (none, d, text), lost in gone.items():
        all_lines, kept, last = text.split("\n"), [], True
        for n, line in enumerate(all_lines):
            last = (n not in lost) if line.encode().split() else last
            if last:
                kept.append(line)
        out[None if none else d, text] = ("\n".join(kept), len(lost))
    return out


def check(docs, rows, least):
    import hashlib
    want = brute([(r[0], r[1]) for r in rows], least)
    got = {r["doc_id"]: (r["kept_sha256"], r["n_deleted"]) for r in lines.report(docs(rows), least).collect()}
    for (d, _), (text, lost) in want.items():
        assert got[d] == (hashlib.sha256(text.encode()).hexdigest(), lost), d
    return want


@pytest.mark.parametrize("seed,least", [(1, 3), (2, 5), (3, 8), (4, 1)])
def test_deletions_match_brute_force(docs, seed, least):
    rnd = random.Random(seed)
    pool = [prose(i, rnd.choice([1, 1, 2, 3, 6])) for i in range(5)] + ["", " "]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.9 else prose(100 + 17 * i + j, 3) for j in range(rnd.randint(1, 14))), "en", "s", 1) for i in range(14)]
    check(docs, rows, least)


def test_copies_overlaps_and_a_common_line(docs):
    long = [prose(i, 30) for i in range(9)]
    rows = [(1, "\n".join(long), "en", "s", 0), (2, "\n".join(long), "en", "s", 0), (3, "\n".join(["common", *long[3:6], "own tail here"]), "en", "s", 0),
            (4, "common\n" + prose(77, 90), "en", "s", 0), (5, "\n".join([long[0]] * 6), "en", "s", 0), (6, prose(77, 90) + "\n\nrest", "en", "s", 0)]
    check(docs, rows, 50)
    out = {r["doc_id"]: r for r in lines.without_repeats(docs(rows, ("gone", "_id"))).collect()}
    assert 2 not in out and out[1]["text"] == rows[0][1] and out[3]["text"] == "common\nown tail here" and out[3]["n_chars"] == 20
    assert out[6]["text"] == "rest" and list(out[1].asDict()) == ["doc_id", "text", "lang", "source", "n_chars", "gone", "_id"]


def test_repeated_rows_are_one_document(docs):
    short, long = "\n".join(prose(i, 12) for i in range(6)), "\n".join(prose(20 + i, 60) for i in range(3))
    rows = [(1, f"{short}\nfirst tail\n{long}", "en", "s", 0), (2, f"own head\n{short}\nown tail", "en", "s", 0), (3, f"{long}\nunique line\nand one more", "en", "s", 0),
            (4, f"{prose(60, 60)}\n{prose(61, 9)}", "en", "s", 0)]
    rows += [rows[1], rows[2], rows[2], rows[3]]
    check(docs, rows, 50)
    out = sorted((r["doc_id"], r["text"]) for r in lines.without_repeats(docs(rows)).collect())
    assert out == sorted([(1, rows[0][1]), *[(2, "own head\nown tail")] * 2, *[(3, "unique line\nand one more")] * 3, *[(4, rows[3][1])] * 2])


def test_awkward_rows(awkward, empty):
    assert sorted(map(str, lines.without_repeats(awkward).collect())) == sorted(map(str, awkward.collect()))
    assert lines.report(awkward).count() == len(AWKWARD)
    assert lines.report(empty).count() == lines.without_repeats(empty).count() == 0


def test_suffix_ranks_sort_the_suffixes(docs):
    rows = [(i, "\n".join("abcab"[(i + j) % 5] for j in range(6)), "en", "s", 0) for i in range(6)]
    active, steps = lines.suffix_ranks(lines.split_lines(docs(rows)), 4)
    assert steps == 2
    got = active.collect()
    first = {r["r0"]: None for r in got}
    order = {rank: i for i, rank in enumerate(sorted(first))}
    text = {(r["_id"], r["place"]): order[r["r0"]] for r in got}
    key = lambda r: tuple(text.get((r["_id"], r["place"] + k), -1) for k in range(4))
    for a in got:
        for b in got:
            assert (a["r2"] < b["r2"]) == (key(a) < key(b))
