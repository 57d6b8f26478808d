import random
import zlib

import numpy as np

from basketry.llm import toxicity
from tests.llm.conftest import AWKWARD, WORDS

RUDE = ["nastygram", "vileness", "rottenest"]


def corpus(n=400):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(rnd.randint(20, 120))]
        if toxic:
            for _ in range(max(2, len(words) // 12)):
                word = rnd.choice(RUDE)
                if zlib.crc32(str(i).encode()) % 5 == 0:  # held out: misspelled in ways not seen in training
                    k = rnd.randrange(2, len(word) - 1)
                    word = word[:k] + "x" + word[k:]
                words.insert(rnd.randrange(len(words)), word)
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_unseen_misspellings_are_found(docs, spark):
    rows, labels = corpus()
    out = toxicity.fit_and_score(docs(rows, ("score",)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 5 == 0}
    rude, clean = ([r["score"] for r in held if (r["doc_id"] % 4 == 0) == kind] for kind in (True, False))
    assert np.mean([a > b for a in rude for b in clean]) >= 0.98  # every word of the rude ones is misspelled
    assert np.mean([s < 0.5 for s in clean]) >= 0.95 and np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]) >= 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)


def test_held_out_labels_and_other_columns_change_nothing(docs, spark):
    rows, labels = corpus(120)
    schema = "doc_id long, quality int, toxic int"
    first = toxicity.fit_and_score(docs(rows), spark.createDataFrame(labels, schema)).collect()
    flipped = [(i, 0, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in labels]
    other = docs([(i, t, "xx", f"z{i}", 9) for i, t, *_ in rows])
    again = toxicity.fit_and_score(other, spark.createDataFrame(flipped, schema)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_awkward_rows(awkward, empty, spark):
    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0), (6, 1, None), (None, 1, 1), (7, 1, 0), (7, 1, 0), (8, 0, 5)], "doc_id long, quality int, toxic int")
    out = toxicity.fit_and_score(awkward, labels).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.fit_and_score(empty, labels).count() == 0
    assert toxicity.fit_and_score(awkward, labels.filter("false")).filter("score = 0.5").count() == len(AWKWARD)


def test_long_texts_are_scored_whole(monkeypatch):
    model = toxicity.Model(np.linspace(-1, 1, 1 << toxicity.BUCKET_BITS).astype(np.float32), 0.1)
    text = " ".join(w + str(i) for i, w in enumerate(WORDS * 50)).encode()
    whole = model.score(text)
    monkeypatch.setattr(toxicity, "CHUNK", 16 * 7)
    assert abs(model.score(text) - whole) < 1e-6


def test_executors_need_no_library(spark, docs, monkeypatch):
    """What is broadcast names none of the library's classes."""
    import pickle
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(pickle.dumps(value)) or broadcast(self, value))
    toxicity.score(docs([(1, "a text", "en", "s", 0)]), toxicity.train([(b"bad word", 1), (b"good word", 0)])).collect()
    assert sent and not any(b"basketry" in value for value in sent)


def plain_buckets(text):
    """Buckets of all byte n-grams of the marked words, one at a time."""
    found = []
    for word in text.decode(errors="replace").lower().encode().split():
        marked = b"\x02" + word + b"\x03"
        for n in toxicity.LENGTHS:
            for start in range(len(marked) - n + 1):
                h = 0
                for b in marked[start:start + n]:
                    h = (h * 0x100000001B3 + b + 1) % 2**64
                h = (h ^ (h >> 32)) * (0x9E3779B97F4A7C15 + 2 * n) % 2**64
                found.append(h >> (64 - toxicity.BUCKET_BITS))
    return found


def test_score_is_that_of_a_plain_loop(monkeypatch):
    model = toxicity.Model(np.linspace(-3, 2, 1 << toxicity.BUCKET_BITS).astype(np.float32), 0.3)
    texts = [b"", b"a", b"One TWO  three\x1cfour \xc3\x89T\xc3\x89", b"x" * 500, b"bad \xff\xfe bytes", b"ab " * 40 + b"y" * 300 + b" z"]
    for chunk in (1 << 20, 64, 7):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        for text in texts:
            found = plain_buckets(text)
            assert sorted(np.concatenate(list(toxicity.ngrams_of(text))).tolist()) == sorted(found)
            mean = sum(float(model.weights[b]) for b in found) / max(1, len(found))
            assert abs(model.score(text) - 1 / (1 + np.exp(-(0.3 + mean)))) < 1e-6


def test_arrays_of_a_long_word_stay_small(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 1000)
    assert max(map(len, toxicity.ngrams_of(b"w" * 50000 + b" and " + b"v " * 5000))) <= 1100 * len(toxicity.LENGTHS)


def test_training_step_is_that_of_a_plain_loop(monkeypatch):
    monkeypatch.setattr(toxicity, "PASSES", 1)
    samples = [(b"vile word here", 1), (b"some good words", 0), (b"good words and more good words", 0)]
    model = toxicity.train(samples, seed=3)
    bags = [plain_buckets(t) for t, _ in samples]
    used = sorted({b for bag in bags for b in bag})
    random = np.random.default_rng(3)
    vectors = dict(zip(used, random.normal(0, 0.1, (len(used), toxicity.DIMENSIONS)).astype(np.float32).tolist()))
    softmax = random.normal(0, 0.1, (toxicity.DIMENSIONS, 2)).astype(np.float32).tolist()
    dims, classes = range(toxicity.DIMENSIONS), range(2)
    weight = [3 / (2 * 2), 3 / (2 * 1)]
    slope, top, base = {b: [0.0 for _ in dims] for b in used}, [[0.0, 0.0] for _ in dims], [0.0, 0.0]
    for bag, (_, label) in zip(bags, samples):
        mean = [sum(vectors[b][d] for b in bag) / len(bag) for d in dims]
        raw = [np.exp(sum(mean[d] * softmax[d][c] for d in dims)) for c in classes]
        error = [(raw[c] / sum(raw) - (c == label)) * weight[label] / len(samples) for c in classes]
        for d in dims:
            for b in bag:
                slope[b][d] += sum(error[c] * softmax[d][c] for c in classes) / len(bag)
            for c in classes:
                top[d][c] += mean[d] * error[c]
        for c in classes:
            base[c] += error[c]
    step = lambda value, g: value - toxicity.RATE * g / (1e-8 + g * g) ** 0.5
    for b in used:
        after = [step(vectors[b][d], slope[b][d]) * (step(softmax[d][1], top[d][1]) - step(softmax[d][0], top[d][0])) for d in dims]
        assert abs(model.weights[b] - sum(after)) < 2e-3
    assert abs(model.prior - (step(0, base[1]) - step(0, base[0]))) < 2e-3
    assert not model.weights[[b for b in range(1000) if b not in slope]].any()
