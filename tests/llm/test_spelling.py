import random
import re
import zlib
from collections import Counter

import pytest

from basketry.llm import spelling
from tests.llm.conftest import WORDS


def edits(word, letters):
    """All texts one edit away."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return ({a + c + b for a, b in cuts for c in letters} | {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters}) - {word}


def brute(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = "".join(c for i, c in enumerate(run) if i != h % len(run))
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= 6 and c >= 5}
    letters = {c for w in n for c in w}
    near = {w: [o for o in edits(w, letters) if o in n] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def texts(seed=3):
    """Words with one slip, chains of slips of falling frequency, letters beyond ASCII and capitals."""
    rnd, rows = random.Random(seed), []
    stems = [a + b for a in WORDS[:8] for b in WORDS[3:9]] + ["straßen", "élèvera", "Überfall", "aaaaaa", "aaaaaaa", "abababab"]
    for i in range(400):
        words = []
        for _ in range(60):
            word = rnd.choice(stems)
            while rnd.random() < 0.3:
                at = rnd.randrange(len(word))
                word = rnd.choice([word[:at] + word[at + 1:], word[:at] + rnd.choice("abé") + word[at:], word[:at] + rnd.choice("abé") + word[at + 1:]])
            words.append(word.upper() if rnd.random() < 0.1 else word)
        rows.append((i, " ".join(words)))
    rows += [(600 + i, " ".join(["Kettenwort"] * 5 + ["kettenwortx"] * (i < 28) + ["kettenwortxy"] * (i < 5))) for i in range(30)]
    return rows + [(7, "repeated repeated"), (7, "repeated repeated"), (None, "repeated nothing"), (500, None), (501, ""), (502, "x" * 3000 + "×÷" + "ab1cd")]


@pytest.mark.parametrize("block, chunk", [(512, 1 << 20), (3, 40)])
def test_matches_brute_force(docs, monkeypatch, block, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rows = texts()
    got = spelling.variants(docs([(i, t, "en", "s", 0) for i, t in rows], ("word", "n", "form", "m")), block=block).collect()
    want = brute(rows)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(f and r != f for _, f, r, *_ in want)  # chains


def test_near_is_one_edit():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(6, 9))) for _ in range(200)]
    import numpy as np
    i, j = (np.array(x) for x in zip(*((a, b) for a in range(200) for b in range(200) if words[a] != words[b])))
    m = np.maximum(*(np.array([len(words[x]) for x in k]) for k in (i, j)))
    found = spelling.near(words, i, j, m, np.ones(len(i), bool))
    assert found.tolist() == [words[b] in edits(words[a], "ab") for a, b in zip(i, j)]


def test_awkward_rows(awkward, empty):
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(awkward).count() == 0
