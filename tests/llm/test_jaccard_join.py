import random

import pytest

from tripstream.llm import jaccard_join as j
from tripstream.llm.components import connected


def brute(docs, n, num, den):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and den * both >= num * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return sorted(((i, len(sets[k]), low.get(root(k))) for k, (i, _) in enumerate(docs)), key=repr)


def made(seed, vocabulary, count):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 5))) for _ in range(vocabulary)]
    lines = [[rng.choice(words) for _ in range(12)] for _ in range(6)]
    docs, texts = [], []
    for i in range(count):
        kind = rng.random()
        if texts and kind < 0.4:                 # near copies of one of the first few
            w = list(texts[rng.randrange(min(len(texts), 8))])
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(w))
                w[at:at + rng.randint(0, 1)] = [rng.choice(words)]
        elif kind < 0.6:                         # boilerplate only
            w = [x for _ in range(rng.randint(1, 6)) for x in rng.choice(lines)]
        else:
            w = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 30, 90, 250]))] + rng.choice(lines)
        texts.append(w)
        docs.append((1000 - i, " ".join(w)))
    return docs


@pytest.mark.parametrize("n, num, den, vocabulary", [(4, 85, 100, 900), (5, 80, 100, 40), (2, 60, 100, 200)])
def test_components_against_brute_force(spark, docs_of, odd, clashing, n, num, den, vocabulary):
    docs = made(n, vocabulary, 160) + odd
    # few groups make a token frequent, so that several levels are needed
    found = j.near_components(clashing(docs_of(docs)), n, num, den, rare=2)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == brute(docs, n, num, den)
    rows = found.collect()
    firsts = {r["first"] for r in rows}
    assert firsts <= {r["r"] for r in rows} and sum(r["r"] == r["first"] for r in rows) == len(firsts)


def test_empty(spark, docs_of):
    assert j.near_components(docs_of([])).count() == 0
    got = j.near_components(docs_of([(3, None), (4, ""), (5, " ")])).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(3, 0, 3), (4, 0, 4), (5, 0, 5)]


def test_connected(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(500, 500)] + [
        (rng.randint(1000, 1060), rng.randint(1000, 1060)) for _ in range(40)]
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long")).collect()))
    low = {x: x for ab in links for x in ab}
    for _ in range(100):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {a: b for a, b in low.items() if a != b}


def family(rng, copies, length, edits, original=True):
    """Near copies of one text that are below the threshold to one another."""
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(length)]
    out = [list(words)] if original else []
    for k in range(copies):
        w = list(words)
        for at in rng.sample(range(length), edits):
            w[at] = f"e{k}x{at}"
        out.append(w)
    return out


@pytest.mark.parametrize("original", [True, False])
def test_family_of_near_copies_below_the_threshold(spark, docs_of, original):
    """Copies of one text with edits of their own, some of them near one another."""
    rng = random.Random(5)
    texts = family(rng, 60, 120, 3, original)
    for k in range(0, 40, 4):                # a near copy of a copy
        w = list(texts[k + 2])
        w[rng.randrange(120)] = "other"
        texts.append(w)
    docs = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(900 + i, t) for i, t in made(3, 60, 60)]
    found = j.near_components(docs_of(docs), 4, 85, 100, rare=2)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == brute(docs, 4, 85, 100)


def test_rows_of_a_hot_family_grow_linearly(spark, docs_of, monkeypatch):
    """1,700 near copies, none near enough to another: no join grows with their square."""
    made_rows = []
    real = j.written

    def counting(df, label, **kw):
        out = real(df, label, **kw)
        if label in ("jaccard-pairs", "jaccard-leaders", "jaccard-widths", "jaccard-edits"):
            made_rows.append((label, out.count()))
        return out

    monkeypatch.setattr(j, "written", counting)
    sums = {}
    for copies in (425, 1700):
        rng, made_rows[:] = random.Random(8), []
        docs = [(i, " ".join(w)) for i, w in enumerate(family(rng, copies, 60, 3))]
        found = j.near_components(docs_of(docs, parts=8), 4, 85, 100)
        assert found.where("doc_id != component_id").count() < copies // 20        # edits side by side
        sums[copies] = sum(n for _, n in made_rows)
    assert sums[1700] < 6 * sums[425], sums


def test_levels_shuffle_the_sets_that_are_left(spark, docs_of, monkeypatch):
    """After the first level only what has too few rare tokens is compared: the other sets stay out of it."""
    rng, seen = random.Random(12), []
    real = j.grouped

    def watched(docs, sets, num, den):
        seen.append((docs.count(), sets.count()))
        return real(docs, sets, num, den)

    monkeypatch.setattr(j, "grouped", watched)
    docs = [(i, " ".join(w)) for i, w in enumerate(family(rng, 40, 80, 4))]
    for k in range(60):                      # pairs of near copies that the first level decides
        a, b = family(rng, 1, 100, 1)
        docs += [(1000 + 2 * k, " ".join(a)), (1001 + 2 * k, " ".join(b))]
    found = j.near_components(docs_of(docs), 4, 85, 100, rare=4)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == brute(docs, 4, 85, 100)
    assert seen and all(left == sets for left, sets in seen), seen
