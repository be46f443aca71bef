import collections
import random
import re

import numpy as np

from tripstream.llm import quality as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts, inside = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            inside |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def made_documents(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = " ".join(rng.choice(words) if good else rng.choice(words).upper() + "!!$" for _ in range(120))
        docs.append((i, text))
        labels.append((i, int(good)))
    return docs, labels


def test_counts_scores_and_edges(spark, docs_of, odd, clashing):
    made, labels = made_documents()
    ldf = spark.createDataFrame(labels + [(None, 1), (3, None), (10**9, 0)] + labels[:5], "doc_id long, quality int")
    model = q.train_quality(docs_of(made[:300]), ldf)
    text_of = odd + [(100, "a b c a b c a b c"), (101, "x y z\u0085 \x1c w"), (102, "l1\nl1\n\n \nl2\r\nl2")]
    rows = sorted(map(tuple, q.judge_quality(clashing(docs_of(text_of)), model).select("doc_id", *q.COUNTS, "kept").collect()), key=repr)
    assert sorted((r[:-1] for r in rows), key=repr) == sorted(((i, *brute(t)) for i, t in text_of), key=repr)
    assert not any(r[-1] for r in rows if r[1] < q.MIN_WORDS)
    held = {i: bool(g) for i, g in labels[300:]}
    got = {r.doc_id: r.kept for r in q.judge_quality(docs_of(made[300:]), model).collect()}
    assert sum(got[i] == held[i] for i in held) >= 0.97 * len(held)
    assert q.judge_quality(docs_of([]), model).count() == 0


def test_batch_scores_equal_single_ones():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=q.BUCKETS).astype(np.float32)
    texts = [t.encode() for _, t in made_documents(50)[0]] + [b"", b"a", b"ab", b"abc d"]
    one = [float(weights[g].astype(float).mean()) if len(g := q.ngram_buckets(t)) else 0.0 for t in texts]
    assert np.allclose(q.ngram_means(texts, weights), one, atol=1e-9)


def test_no_labels_or_one_class(spark, docs_of):
    docs = docs_of(made_documents(20)[0])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert q.train_quality(docs, none).prior == 1.0
    bad = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    assert q.judge_quality(docs, q.train_quality(docs, bad)).where("kept").count() == 0
