import random
import zlib

import numpy as np
import pytest

from tripstream.llm import language_id as l

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"aa": "ka to mi ru ne so".split(), "bb": "schl ung ein pfa ött zer".split(), "cc": "oui eau tre èle que ion".split()}


def sentence(rng, lang, n=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    return [(i, sentence(rng, lang, rng.randint(5, 60)), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", None) for i, t, g in rows], SCHEMA).repartition(3)


def by_hand(text):
    """Trigram counts of a text, one letter at a time."""
    out, low = {}, f"\n{text.lower()}\n"
    for a, b, c in zip(low, low[1:], low[2:]):
        if b.isalpha():
            key = "".join(x if x.isalpha() else " " for x in (a, b, c))
            out[key] = out.get(key, 0) + 1
    return out


def test_counts_equal_counting_by_hand(monkeypatch):
    texts = ["", "a", "  Été où? l'EAU 12 x", "ßẞ İi ...", "日本 語", "no\nlines\n\nhere\t"]
    number, bucket, count = l.counted([t.encode() for t in texts])
    for k, t in enumerate(texts):
        hand = by_hand(t)
        assert sorted(count[number == k]) == sorted(hand.values())
        assert count[number == k].sum() == sum(c.isalpha() for c in t.lower())
    long = " ".join(texts) * 50
    whole = l.counted([long.encode()])
    monkeypatch.setattr(l, "PIECE", 37)
    for a, b in zip(whole, l.counted([long.encode()])):
        assert (a == b).all()


def test_mixture_equals_plain_em_and_keeps_sets_small():
    rng = np.random.default_rng(0)
    names = ["a", "b", "c"]
    logs = np.log(rng.dirichlet(np.ones(l.BUCKETS), 3).T).astype(np.float32)
    model = l.LanguageModel(names, logs)
    rnd = random.Random(0)
    texts = ["".join(rnd.choice("abcdefgh ") for _ in range(n)).encode() for n in (5, 300, 4000)]
    together, _ = model.mixtures(texts)
    for k, t in enumerate(texts):
        alone, _ = model.mixtures([t])
        assert np.allclose(together[k], alone[0])
        _, bucket, count = l.counted([t])
        p, share = np.exp(logs[bucket].astype(float)), np.ones(3) / 3
        for _ in range(l.STEPS):
            share = (count[:, None] * p * share / (p @ share)[:, None]).sum(axis=0) / count.sum()
        kept = alone[0] > 0
        assert set(np.flatnonzero(kept)) == set(np.argsort(-share, kind="stable")[:kept.sum()])


def test_held_out_accuracy_and_mixed_texts(spark):
    rows = corpus()
    rng = random.Random(9)
    mixed = [(10_000 + k, sentence(rng, "aa", 80) + " " + sentence(rng, "cc", 40), None) for k in range(20)]
    docs = frame(spark, rows + mixed)
    model = l.train_languages(docs)
    assert model.names == sorted(SYLLABLES)
    got = {r.doc_id: r for r in l.identify(docs, model).collect()}
    held = [(i, g) for i, _, g in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert np.mean([got[i].lang_pred == g for i, g in held]) > 0.98
    assert np.mean([len(got[i].langs) == 1 for i, g in held]) > 0.98
    for i, _, _ in mixed:
        assert [x.lang for x in got[i].langs] == ["aa", "cc"]
        assert got[i].lang_pred == "aa" and 0.5 < got[i].score < 0.85


def test_labels_of_held_out_rows_and_other_columns_play_no_part(spark):
    rows = corpus(120)
    lied = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else g) for i, t, g in rows]
    a, b = (l.train_languages(frame(spark, r)) for r in (rows, lied))
    assert a.names == b.names and (a.logs == b.logs).all()


def test_odd_rows(spark, docs_of, odd, clashing):
    model = l.train_languages(frame(spark, corpus(60)))
    more = odd + [(50, "123 ... !?"), (51, "日本語"), (52, "ka" * 700_000), (53, "²Ⅳ")]
    got = l.identify(clashing(docs_of(more)), model).collect()
    assert len(got) == len(more)
    by_id = {r.doc_id: r for r in got}
    for i in (1, 2, 3, 50, 53):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].langs) == ("und", 0.0, [])
    assert by_id[52].lang_pred == "aa" and by_id[51].lang_pred in model.names
    assert all(0 <= r.score <= 1 for r in got)
    assert l.identify(docs_of([]), model).count() == 0
    none = l.train_languages(docs_of([]))
    assert none.names == [] and {r.lang_pred for r in l.identify(docs_of(odd), none).collect()} == {"und"}


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(l, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2"):
        l.train_languages(frame(spark, corpus(60)))
