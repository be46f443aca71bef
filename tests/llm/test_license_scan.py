import random
import re

from tripstream.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    places = [(i, t.label) for t in ls.BASE for i in range(len(w)) if w[i:i + len(t.words.split())] == t.words.split()]
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def test_base_places_and_method(spark, docs_of, odd, clashing):
    rng = random.Random(1)
    phrases = [t.words for t in ls.BASE + ls.METHOD]
    filler = ["the", "of", "cc", "by", "general", "public", "all", "rights", "é", "x9", "license", "under"]
    docs = odd + [(100 + k, rng.choice([" ", ", ", "-\n"]).join(
        rng.choice(phrases if rng.random() < 0.3 else filler).upper() for _ in range(rng.randint(1, 30)))) for k in range(150)]
    docs += [(300, "Licensed under the Apache License, Version 2.0."), (301, "licensed under the new apache license version 2.0"),
             (302, "under the license of the apache"), (303, "CC BY-NC; cc__by"), (304, "cc"), (305, "Kcc by K")]
    rows = ls.scan_licenses(clashing(docs_of(docs))).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)
    assert got == sorted(((i, *base(t)) for i, t in docs), key=repr)
    by = {r.doc_id: r for r in rows}
    assert by[300].labels == "apache-2.0" and by[300].score == 1.0
    assert by[301].labels == "apache-2.0" and 0.75 <= by[301].score < 1      # a word put in: two diagonals
    assert by[302].labels == "" and by[302].score == 0.0 and by[4].score == 0.0
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert ls.scan_licenses(docs_of([])).count() == 0


def test_whole_license_texts(spark, docs_of):
    """A whole text is found, with words put in or left out; far less of it is not."""
    mit = next(t for t in ls.TEXTS if t.label == "mit").words.split()
    bsd = next(t for t in ls.TEXTS if t.label == "bsd").words.split()
    assert len(mit) > 150 and len(bsd) > 200
    cut = [w for k, w in enumerate(bsd) if k % 23 != 5]
    docs = [(1, "x " * 500 + " ".join(mit).upper() + " y" * 500), (2, ", ".join(cut)), (3, " ".join(bsd[60:120])), (4, "z " * 90)]
    by = {r.doc_id: r for r in ls.scan_licenses(docs_of(docs), method=ls.TEXTS).collect()}
    assert by[1].labels == "mit" and by[1].score == 1.0
    span = max(by[1].spans, key=lambda s: s.end - s.start)
    assert (span.start, span.end) == (500, 500 + len(mit))
    assert by[2].labels == "bsd" and 0.75 <= by[2].score < 1 and by[3].labels == by[4].labels == ""


def test_linear_in_a_text(spark, docs_of):
    """As many words in a few long texts cost about as much as in short ones."""
    import time

    def seconds(texts):
        df = docs_of(list(enumerate(texts)), parts=1).cache()
        df.count()
        t = time.time()
        assert sum(r.n_words for r in ls.scan_licenses(df).select("n_words").collect()) == 600_000
        return time.time() - t

    words = "the license of a cc by text under general terms ".split()
    seconds([" ".join(words[k % 10] for k in range(1000))] * 600)          # compiles
    short = seconds([" ".join(words[k % 10] for k in range(1000))] * 600)
    long = seconds([" ".join(words[k % 10] for k in range(300_000))] * 2)
    assert long < 3 * short + 3, (short, long)


def test_native_plan(spark, docs_of):
    plan = ls.scan_licenses(docs_of([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
