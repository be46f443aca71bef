"""Language identification: each document as a mixture of the learned languages.

*Model*: per language the counts of letter trigrams (a letter with the
characters beside it, lower-cased, anything but a letter as a blank), hashed to
``BUCKETS``; counted in the tasks over every whole training text and summed by
Spark, smoothed on the driver. Its size is languages x buckets.

*Inference*: a text's trigrams are taken as drawn from a mixture of the
languages. Expectation-maximisation finds the proportions. Then sets of
languages are compared, the largest proportions first, one more at a time:
proportions are fitted again within the set, and one more language must raise the
log-likelihood by ``PENALTY * log(trigrams)``. ``lang_pred`` is the language with
the largest proportion of the set that is left (ties: the smaller name),
``score`` that proportion, ``langs`` the whole set by proportion.

All texts of a slice of an Arrow batch are fitted together; a text's trigrams
are counted first (a long text in pieces), so memory does not grow with a text.
One pass over the documents to learn and one to predict; no text is shuffled.

Edge cases: null text, or no letter in it -> ``und`` with score 0; rows with null
lang or null doc_id are not learned from, null doc_id is not held out; no learned
language -> ``und``; empty table -> no rows; repeated rows are learned from and
judged one by one; other columns are ignored. More than ``MOST_LANGUAGES``
learned values are an error: the column then holds no languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tripstream.llm.common import chunked, ready

BITS = 16
BUCKETS = 1 << BITS
SMOOTHING = 0.05         # added to each bucket's count
STEPS = 12               # of expectation-maximisation, per fit
PENALTY = 3.0            # neighbouring trigrams share letters: three times the plain term
MOST_LANGUAGES = 1000
HELD_OUT = 5             # one in five documents is not learned from

PIECE = 1 << 20          # characters of a text that are counted at once
SLICE = 1 << 18          # bytes of texts that are fitted together, times 4 languages

UNDETERMINED = "und"

_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)]
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once in a task."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def trigrams(low: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter of a lower-cased text, its first
    and last character left out as middles, and where in the text it is."""
    raw = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[raw]
    x = np.where(letter, raw, np.uint32(0))
    at = np.flatnonzero(letter[1:-1]) + 1
    with np.errstate(over="ignore"):
        h = (x[at - 1] * _MIX[0]) ^ (x[at] * _MIX[1]) ^ (x[at + 1] * _MIX[2])
        h = (h ^ (h >> np.uint32(15))) * _MIX[0]
    return (h >> np.uint32(32 - BITS)).astype(np.int64), at


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and count of the distinct trigrams of some texts, in order."""
    low = [x.decode("utf-8", "replace").lower() for x in texts]
    if len(low) == 1 and len(low[0]) > PIECE:
        sums, text = np.zeros(BUCKETS, np.int64), f"\n{low[0]}\n"
        for s in range(1, len(text) - 1, PIECE):
            sums += np.bincount(trigrams(text[s - 1:s + PIECE + 1])[0], minlength=BUCKETS)
        where = np.flatnonzero(sums)
        return np.zeros(len(where), np.int64), where, sums[where]
    bucket, at = trigrams("\n" + "".join(x + "\n" for x in low))
    edges = np.cumsum([1] + [len(x) + 1 for x in low])
    key, count = np.unique((np.searchsorted(edges, at, side="right") - 1) * BUCKETS + bucket, return_counts=True)
    return key >> BITS, key & (BUCKETS - 1), count


@dataclass
class LanguageModel:
    """Names (sorted) and the logarithm of each trigram's probability by language."""

    names: list[str]
    logs: np.ndarray             # bucket, language: float32

    def _fit(self, p: np.ndarray, count: np.ndarray, start: np.ndarray, text_of: np.ndarray,
             allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions by text and language within ``allowed``, and log-likelihoods."""
        total = np.add.reduceat(count, start)[:, None]
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for step in range(STEPS + 1):
            mixed = p * share[text_of]
            whole = mixed.sum(axis=1)
            if step < STEPS:
                share = np.add.reduceat(mixed * (count / whole)[:, None], start) / total
        return share, np.add.reduceat(count * np.log(whole), start)

    def mixtures(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of each text's languages (0 outside its set), and which texts
        have a letter. Texts without one have no proportions."""
        out = np.zeros((len(texts), len(self.names)))
        number, bucket, count = counted(texts)
        known, start = np.unique(number, return_index=True)
        found = np.zeros(len(texts), bool)
        found[known] = True
        if not len(known) or not self.names:
            return out, found
        logs = self.logs[bucket].astype(np.float64)
        # trigrams relative to their likeliest language: no underflow, the same proportions
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        count, text_of = count.astype(np.float64), np.searchsorted(known, number)
        size = len(self.names)
        n = np.add.reduceat(count, start)
        share, _ = self._fit(p, count, start, text_of, np.ones((len(known), size)))
        order = np.argsort(-share, axis=1, kind="stable")
        top = order[:, 0]
        best = np.zeros((len(known), size))
        best[np.arange(len(known)), top] = 1.0
        single = np.add.reduceat(count * np.log(p[np.arange(len(p)), top[text_of]]), start)
        open_texts = np.ones(len(known), bool)
        for k in range(2, size + 1):
            rows = np.flatnonzero(open_texts)
            tokens = np.flatnonzero(open_texts[text_of])
            allowed = np.zeros((len(rows), size))
            np.put_along_axis(allowed, order[rows, :k], 1.0, axis=1)
            at = text_of[tokens]
            first = np.flatnonzero(np.diff(at, prepend=-1))
            got, like = self._fit(p[tokens], count[tokens], first, np.searchsorted(rows, at), allowed)
            better = like - single[rows] > PENALTY * np.log(n[rows] + 1)
            best[rows[better]], single[rows[better]] = got[better], like[better]
            open_texts[rows[~better]] = False
            if not better.any():
                break
        out[known] = best
        return out, found


def held_out() -> Column:
    """Whether a document is kept from learning, by its doc_id as text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def _counts(rows: DataFrame) -> DataFrame:
    """``lang, bucket, n`` of rows (text: binary, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def made():
            for lang, x in sums.items():
                where = np.flatnonzero(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(where), pa.string()), pa.array(where.astype(np.int32)), pa.array(x[where])],
                    names=["lang", "bucket", "n"])
            sums.clear()

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            lengths = pc.coalesce(pc.binary_length(batch.column(0)), 0).to_pylist()
            for start, end in chunked(lengths, SLICE):
                texts = [x or b"" for x in batch.column(0).slice(start, end - start).to_pylist()]
                number, bucket, n = counted(texts)
                lang_of = langs[start:end][number]
                for lang in set(langs[start:end]):
                    mine = lang_of == lang
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    np.add.at(sums[lang], bucket[mine], n[mine])
            if len(sums) > 64:
                yield from made()
        yield from made()

    return (rows.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def train_languages(documents: DataFrame) -> LanguageModel:
    """Learn from the documents that are not held out and have text and lang."""
    ready(documents.sparkSession)
    rows = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out()).select(F.col("text").cast("binary").alias("t"), F.col("lang").alias("g"))
    values = rows.select("g").distinct().limit(MOST_LANGUAGES + 1).toArrow().column(0).to_pylist()
    if len(values) > MOST_LANGUAGES:
        raise ValueError(f"lang holds more than {MOST_LANGUAGES} values")
    # languages x buckets rows at most
    got = _counts(rows).toArrow()
    names = sorted(set(got["lang"].to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    if names:
        counts[got["bucket"].to_numpy(), np.searchsorted(names, got["lang"].to_pylist())] = got["n"].to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)
    return LanguageModel(names, np.log(p).astype(np.float32))


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, langs`` per document; langs: the
    languages of its set with their proportions, largest first."""
    spark = documents.sparkSession
    ready(spark)
    box = spark.sparkContext.broadcast((model.names, model.logs))     # languages x buckets numbers
    size = max(1 << 12, SLICE * 4 // max(4, len(model.names)))
    rows = documents.select(F.col("text").cast("binary").alias("t"), F.col("doc_id").alias("i"), held_out().alias("h"))
    kind = rows.schema["i"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*box.value)
        for batch in batches:
            lengths = pc.coalesce(pc.binary_length(batch.column(0)), 0).to_pylist()
            for start, end in chunked(lengths, size):
                part = batch.slice(start, end - start)
                share, found = model.mixtures([x or b"" for x in part.column(0).to_pylist()])
                if not model.names:
                    found[:] = False
                order = np.argsort(-share, axis=1, kind="stable") if model.names else None
                names, scores, sets = [], [], []
                for k, ok in enumerate(found):
                    top = [j for j in order[k] if share[k, j] > 0] if ok else []
                    names.append(model.names[top[0]] if top else UNDETERMINED)
                    scores.append(float(min(1.0, share[k, top[0]])) if top else 0.0)
                    sets.append([{"lang": model.names[j], "share": float(min(1.0, share[k, j]))} for j in top])
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                    names=["doc_id", "held_out", "lang_pred", "score", "langs"])

    return rows.mapInArrow(judge, f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
                                  "langs array<struct<lang: string, share: double>>")
