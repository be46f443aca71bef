import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tripstream.llm import packing as p


TOKENIZER = Tokenizer.from_file(p.tokenizer_path())


def whole(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, size):
    """Pieces hold exactly the documents' ids; sequences are gapless and short enough."""
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    expect = {}
    for i, t in docs:
        expect.setdefault(i, []).append(whole(t))
    got = sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = [(repr(i), k, a, len(ids[a:a + size]), zlib.crc32(np.array(ids[a:a + size], "<u4").tobytes()))
            for i, all_ids in expect.items() for ids in all_ids for k, a in enumerate(range(0, len(ids), size))]
    assert got == sorted(want)
    return len(places)


TEXTS = ["İstanbul ΣΑΣ", "a b c", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "don't I'LL 12 3a4", "ﬁ ½ ² 日本",
         "né, été... wor-ld!! x_ ’s", "﻿x", "\x00 a\x00b", "ÉTÉ Öl ß ñandú", "é Å", "_a a_b. (c)d!e"]


def test_packing_edges_and_tokens(spark, docs_of, odd, clashing):
    docs = odd + [(100 + k, t) for k, t in enumerate(TEXTS)] + [(200, "x" * 50_000)]
    n = check(p.pack_documents(clashing(docs_of(docs)), size=64).collect(), docs, 64)
    total = sum(len(whole(t)) for _, t in docs)
    assert n <= -(-total // 64) + 2
    assert p.pack_documents(docs_of([])).count() == 0


def test_few_sequences_over_groups(spark, docs_of, monkeypatch):
    rng = random.Random(2)
    docs = [(i, " ".join("ab" for _ in range(rng.randint(1, 400)))) for i in range(600)]
    monkeypatch.setattr(p, "GROUP", 100)
    n = check(p.pack_documents(docs_of(docs), size=512).collect(), docs, 512)
    total = sum(len(whole(t)) for _, t in docs)
    assert n <= 1.02 * -(-total // 512) + 1


def test_cache_of_two_generations(monkeypatch):
    monkeypatch.setattr(p, "CACHE", 50)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcé,.!") for _ in range(rng.randint(1, 5))) for _ in range(40)) for _ in range(60)]
    cache = p.IdCache(p.tokenizer_path())
    got = [x for k in range(0, 60, 7) for x in cache.encode([t.encode() for t in texts[k:k + 7]])]
    assert got == [np.array(whole(t)[:-1], "<u4").tobytes() for t in texts]


def test_tasks_of_a_worker_share_the_cache(spark, docs_of):
    def known(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(p.id_cache(path).young)]})

    path = p.tokenizer_path()
    docs = docs_of([(i, f"word{i}") for i in range(64)])
    p.token_pieces(docs, path).collect()
    # what the tasks before this one learned
    assert max(r.n for r in docs.select("doc_id").mapInArrow(known, "n long").collect()) > 0


def test_local_search_beats_best_fit():
    rng = random.Random(7)
    better = 0
    for _ in range(200):
        lengths = np.array([rng.randint(1, 60) for _ in range(rng.randint(1, 40))])
        bins = p.best_fit(lengths, 64)
        after = p.local_search([list(b) for b in bins], lengths, 64)
        assert sorted(k for b in after for k in b) == list(range(len(lengths)))
        assert all(lengths[b].sum() <= 64 for b in after)
        fills = [sum((lengths[b].sum()) ** 2 for b in x) for x in (bins, after)]
        assert fills[1] >= fills[0] and len(after) <= len(bins)
        better += len(after) < len(bins)
    assert better > 0
