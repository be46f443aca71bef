import random

import numpy as np

from tripstream.llm import decontaminate as d

LETTERS = "abcdefghijklmnop"


def words(rng, n):
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    sets = [(i, grams(t)) for i, t in items]
    out = []
    for doc, text in docs:
        have = grams(text)
        out += [(doc, i, len(s), len(s & have)) for i, s in sets if s and len(s & have) >= 0.8 * len(s)]
    return out


def made(seed=3):
    rng = random.Random(seed)
    sizes = [5, 6, 9, 11, 12, 16, 36, 37, 60, 200, 700] * 3
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate(sizes)] + [(90, None), (91, ""), (92, "a b c"), (0, "x y z a b c")]
    docs = []
    for i in range(160):
        w = words(rng, rng.choice([0, 3, 40, 70, 300, 3000]))
        for _, text in rng.sample(items[:33], rng.choice([0, 1, 2])):
            copy = text.split()
            for _ in range(rng.choice([0, 0, 1, 2])):      # some edits
                copy[rng.randrange(len(copy))] = "edited"
            at = rng.randint(0, len(w))
            w[at:at] = copy
        docs.append((i, " ".join(w).upper() if i % 9 == 0 else " ".join(w)))
    return docs, items


def test_contained_items(spark, docs_of, odd, clashing, monkeypatch):
    docs, items = made()
    docs = docs + odd + docs[:3]
    idf = spark.createDataFrame(items, "item_id long, text string")
    df = clashing(docs_of(docs))
    monkeypatch.setattr(d, "BLOCK_ITEMS", 10)              # several passes
    got = sorted(map(tuple, d.contained_items(df, idf).collect()), key=repr)
    assert got == sorted(brute(docs, items), key=repr) and len(got) > 50
    clean = d.clean(df, idf)
    assert clean.columns == df.columns
    dirty = {t for t in (t for _, t in docs) if t and brute([(0, t)], items)}
    assert sorted((r.doc_id, r.text) for r in clean.where("doc_id IS NOT NULL").collect() if r.text is not None) == \
        sorted((i, t) for i, t in docs if i is not None and t is not None and t not in dirty)
    assert clean.where("text IS NULL").count() == sum(t is None for _, t in docs)


def test_items_scattered_in_chunks(spark, docs_of):
    """Items cut into chunks of 6 to 10 words with other words between, some edited: an item
    is found where 80 % of its shingles are still in the document."""
    rng = random.Random(12)
    items = [(i, " ".join(words(rng, rng.choice([40, 80, 160])))) for i in range(30)]
    docs = []
    for i in range(150):
        w, rest = words(rng, 100), items[i % 30][1].split()
        while rest:
            n = rng.randint(6, 10) if i % 2 else rng.randint(30, 60)
            w += rest[:n] + words(rng, rng.randint(1, 9))
            rest = rest[n:]
        docs.append((i, " ".join(w)))
    docs += [(200 + k, t.replace(t.split()[len(t.split()) // 2], "edited")) for k, (_, t) in enumerate(items)]
    idf = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, d.contained_items(docs_of(docs), idf).collect()))
    assert got == sorted(brute(docs, items)) and len(got) >= 60


def test_empty_tables(spark, docs_of):
    docs, items = made()
    idf = spark.createDataFrame(items, "item_id long, text string")
    assert d.contained_items(docs_of([]), idf).count() == 0
    assert d.contained_items(docs_of(docs[:5]), idf.limit(0)).count() == 0
    assert d.clean(docs_of(docs[:5]), idf.limit(0)).count() == 5


def test_hash_functions_needed():
    assert d.hashes_needed(32, 16) == 1
    assert d.hashes_needed(12, 64) > d.hashes_needed(32, 64) > d.hashes_needed(32, 32)
    # the promised chance, by simulation of shared minima at the least similarity
    j = 0.8 * 12 / (64 + 12 - 0.8 * 12)
    assert (1 - j) ** d.hashes_needed(12, 64) <= d.MISS
    assert len(set(d.hash_functions(100).tolist())) == 100 and np.all(d.hash_functions(50) % 2 == 1)
