import random

import numpy as np
import pytest

from basketry.llm import near_copies, simhash


def brute(texts):
    """The number of each text's component: Jaccard of 5-word shingles of at least 0.8."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        sets.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set())
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (a == b or 10 * len(a & b) >= 8 * len(a | b)):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def pool(seed, copies):
    """Texts of 150 to 250 words, each with ``copies`` that have one to seven words changed."""
    rnd, out = random.Random(seed), []
    for _ in range(30):
        base = [f"w{rnd.randrange(500)}" for _ in range(rnd.randint(150, 250))]
        out.append(" ".join(base))
        for _ in range(copies):
            new = base[:]
            for at in rnd.sample(range(len(new)), rnd.randint(1, 7)):
                new[at] = f"x{rnd.randrange(500)}"
            out.append(" ".join(new))
    return out


def test_one_of_each_component_by_brute_force(docs):
    texts = pool(1, 1) + pool(2, 4) + ["one two three", "One  two THREE", "one two"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    group, first = brute(texts), {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs(rows, ("cls", "root", "bands"))).collect()) == sorted(first.values())
    assert simhash.keep_one(docs(rows)).count() > len(first)


def families(seed, common, own, changed, count):
    """Texts that share a template, each with a copy that has a few words changed."""
    rnd, out = random.Random(seed), []
    template = [f"t{i}" for i in range(common)]
    for f in range(count):
        base = template + [f"f{f}x{rnd.randrange(10**6)}" for _ in range(own)]
        copy = base[:]
        for at in rnd.sample(range(len(copy)), changed):
            copy[at] = f"y{rnd.randrange(10**6)}"
        out += [" ".join(base), " ".join(copy)]
    return out


@pytest.mark.parametrize("common, own, changed, block", [(170, 30, 2, 512), (170, 30, 2, 4), (150, 50, 3, 16), (170, 30, 5, 16)])
def test_links_between_components_that_share_all_buckets(docs, monkeypatch, common, own, changed, block):
    """Families of a template meet in the same buckets, and none is like another."""
    monkeypatch.setattr(near_copies.other_links, "__defaults__", (block,))
    texts = families(7, common, own, changed, 40)
    group, first = brute(texts), {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    kept = near_copies.keep_one(docs([(i, t, "en", "s", 0) for i, t in enumerate(texts)], ("a", "b", "low"))).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(first.values())


def test_names_with_dots(docs):
    from basketry.llm import lines, mixing, quality
    table = docs([(i, t, "en", "s", 0) for i, t in enumerate(pool(9, 1))], ("a.b", "x`y", "n", "low", "_n"))
    for stage in (quality.keep, lines.without_repeats, near_copies.keep_one, mixing.mixed):
        out = stage(table)
        assert out.columns == table.columns and out.first()["a.b"] == 0 and out.first()["_n"] == 4


def test_awkward_rows(docs, awkward, empty):
    kept = near_copies.keep_one(awkward).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 6, 8, 9]
    assert sum(r["doc_id"] is None for r in kept) == 1 and near_copies.keep_one(empty).count() == 0


def test_stage_removes_near_copies(spark, docs):
    import corpus_pipeline
    texts = pool(5, 1)
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs([(i, t, "en", "s", 0) for i, t in enumerate(texts)]), "")
    assert out.count() == len(set(brute(texts)))


def ball(words):
    """All points of the balls around packed words, one by one."""
    out = set()
    for no, word in enumerate(words.tolist()):
        for flips in range(1 << near_copies.UNSURE):
            bits = word & (1 << near_copies.WORD_BITS) - 1
            for k in range(near_copies.UNSURE):
                if flips >> k & 1:
                    bits ^= 1 << (word >> near_copies.WORD_BITS + 5 * k & 31)
            out.add((no, bits))
    return out


def at_the_limit(rnd, size):
    """Two sets of shingles with the least common part that makes them near copies, of equal size or one inside the other."""
    for own in range(size, -1, -1):
        for a, b in ((own, own), (own, 0)):
            if 10 * (size - own) >= 8 * (size - own + a + b):
                draw = rnd.randint(0, 1 << 63, size - own + a + b, dtype=np.int64).astype(np.uint64)
                return draw[:size - own + a], np.concatenate([draw[:size - own], draw[size - own + a:]])


@pytest.mark.parametrize("size", [5, 9, 12, 40, 300])
def test_near_copies_meet_at_a_point_of_their_balls(size):
    rnd = np.random.RandomState(size)
    met = [len(ball(near_copies.words(a)) & ball(near_copies.words(b))) for a, b in (at_the_limit(rnd, size) for _ in range(400))]
    assert min(met) > 0


def test_points_are_the_ball_around_each_word(spark):
    rnd = np.random.RandomState(1)
    found = {cls: near_copies.words(np.unique(rnd.randint(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64))) for cls in (-5, 3)}
    rows = near_copies.balls(spark.createDataFrame([(c, w.tolist()) for c, w in found.items()], "cls long, words array<long>")).collect()
    size = 1 << near_copies.WORD_BITS
    assert len(rows) == 2 * near_copies.WORDS << near_copies.UNSURE
    assert {(r["cls"], divmod(r["point"], size)) for r in rows} == {(c, p) for c, w in found.items() for p in ball(w)}


def test_pairs_at_the_limit_are_linked(docs):
    """Blocks of words exchanged, added or cut, so that the similarity is 0.8 or just under it; small and larger texts."""
    rnd, texts = random.Random(11), []
    for i in range(240):
        n = rnd.choice([9, 13, 40, 120, 260])
        base = [f"b{i}w{k}" for k in range(n)]
        share, kind = (n - 4) // 5 + rnd.randint(-1, 0), i % 3
        other = base + [f"o{i}w{k}" for k in range((n - 4) // 4)] if kind == 0 else base[max(0, share):] if kind == 1 else base[:n - max(1, share // 2)] + [f"o{i}w{k}" for k in range(max(1, share // 2))]
        texts += [" ".join(base), " ".join(other)]
    group, first = brute(texts), {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    assert 300 > len(first) > 240
    kept = near_copies.keep_one(docs([(i, t, "en", "s", 0) for i, t in enumerate(texts)])).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(first.values())
