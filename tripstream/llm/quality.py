"""Quality rules: counts of a document, and a trained classifier.

*Base rules* reject a document with fewer than ``MIN_WORDS`` words or with
more than ``MAX_REPEAT_PERCENT`` % of its words inside repeated 3-word windows.

*Method*: a logistic regression over hashed n-grams (single words, word
pairs, byte triples), trained on labelled rows and
calibrated (Platt) on labelled rows kept apart. A text's features are the
shares of its n-grams per bucket, so its score is the mean weight of its
n-grams: one gather per n-gram, no feature vector. Texts are scored in Arrow
batches, in one pass over the documents without a shuffle, and kept when the
calibrated probability reaches the fixed ``THRESHOLD``.

The model is fitted on at most ``TRAIN_ROWS`` labelled documents (those with
the smallest hash of doc_id, whatever the table's size); it has a fixed size
and travels with the tasks. Counting and scoring cover every whole text.

Edge cases: null or empty text -> no words, base_failed, not kept; labels
with null doc_id or null quality, or without a document, are left out, of
repeated labels the smallest quality counts; with no labels, or of one class
only, every text gets that class's share (1.0 without labels); empty table ->
no rows; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tripstream.llm.common import chunked, hash_texts, mix64, shingle_hashes, word_hashes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

TRAIN_ROWS = 1500        # labelled documents used at most: 4/5 to train, 1/5 to calibrate
BITS = 16
BUCKETS = 1 << BITS
THRESHOLD = 0.5
STEPS = 100
L2 = 1e-5

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _triples(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(np.uint32)
    with np.errstate(over="ignore"):
        x = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
        return (x * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _pairs(words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((words[:-1] * _ODD + words[1:]) * _ODD) >> np.uint64(64 - BITS)


def ngram_buckets(text: bytes) -> np.ndarray:
    """Buckets of all n-grams of a text: words, word pairs, byte triples."""
    words = word_hashes(text.lower())
    parts = [words >> np.uint64(64 - BITS), _pairs(words), _triples(np.frombuffer(text, np.uint8))]
    return np.concatenate([x.astype(np.int64) for x in parts])


def ngram_means(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams of each text (0 without any)."""
    words, at = hash_texts([x.lower() for x in texts])
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))

    def add(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        last = np.maximum(first, last)
        total = np.concatenate(([0.0], np.cumsum(weights[values], dtype=np.float64)))
        sums[:] += total[last] - total[first]
        counts[:] += last - first

    add(words >> np.uint64(64 - BITS), at[:-1], at[1:])
    add(_pairs(words), np.minimum(at[:-1], max(0, len(words) - 1)), np.minimum(at[1:] - 1, max(0, len(words) - 1)))
    edges = np.cumsum([0] + [len(x) for x in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    top = max(0, len(raw) - 2)
    add(_triples(raw), np.minimum(edges[:-1], top), np.minimum(edges[1:] - 2, top))
    return sums / np.maximum(counts, 1)


def base_counts(texts: list[bytes], chars: list[int]) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text.

    Windows are equal when their 64-bit hashes are.
    """
    words, at = hash_texts(texts)
    n = np.diff(at)
    blanks = np.array([len(x) - len(x.translate(None, b" \t\n\v\f\r")) for x in texts], np.int64)
    symbols = np.array([len(x) - len(x.translate(None, SYMBOLS)) for x in texts], np.int64)
    dups = []
    for x in texts:
        lines = [y for y in x.split(b"\n") if y.strip()]
        dups.append(len(lines) - len(set(lines)))
    repeated = np.zeros(len(texts), np.int64)
    if len(words) > 3:
        # a window's key holds its text's number; windows over a text's end are left out
        text_of = np.repeat(np.arange(len(texts)), n)
        windows = shingle_hashes(words, 3)
        inner = text_of[:-2] == text_of[2:]
        with np.errstate(over="ignore"):
            windows = mix64(windows + text_of[:-2].astype(np.uint64) * _ODD)
        order = np.sort(windows[inner])
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            again = np.isin(windows, twice) & inner
            inside = np.zeros(len(words), bool)
            for j in range(3):
                inside[j:j + len(windows)] |= again
            repeated = np.bincount(text_of[inside], minlength=len(texts))
    return [n, np.asarray(chars) - blanks, symbols, np.array(dups), repeated]


@dataclass
class QualityModel:
    weights: np.ndarray      # float32, a weight per bucket
    bias: float
    slope: float             # Platt calibration of the raw score
    offset: float
    prior: float | None = None   # no model: every text gets this probability

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        raw = self.bias + ngram_means(texts, self.weights)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * raw + self.offset, -50, 50)))


def _features(documents: DataFrame, labels: DataFrame, rows: int) -> list:
    """At most ``rows`` labelled documents: quality, sparse n-gram shares."""
    sample = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
             .join(F.broadcast(sample), "doc_id"))    # ``rows`` pairs of numbers at most

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, quality in zip(*(c.to_pylist() for c in batch.columns)):
                where, count = np.unique(ngram_buckets(text or b""), return_counts=True)
                share = (count / max(1, count.sum())).astype(np.float32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc], pa.int64()), "quality": pa.array([quality], pa.int32()),
                    "at": pa.array([where.astype(np.int32).tobytes()], pa.binary()),
                    "share": pa.array([share.tobytes()], pa.binary())})

    found = texts.mapInArrow(grams, "doc_id long, quality int, at binary, share binary")
    # a doc_id may repeat: never more rows than the sample
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("at", "share")).limit(rows).collect()


def train_quality(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents; deterministic."""
    found = _features(documents, labels, rows)
    y = np.array([min(1, max(0, r["quality"])) for r in found], np.float64)
    if not len(y) or y.min() == y.max():
        return QualityModel(np.zeros(BUCKETS, np.float32), 0.0, 1.0, 0.0, float(y.mean()) if len(y) else 1.0)
    at = [np.frombuffer(r["at"], np.int32) for r in found]
    share = [np.frombuffer(r["share"], np.float32) for r in found]
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    cols = np.concatenate([at[k] for k in train])
    vals = np.concatenate([share[k] for k in train]).astype(np.float64)
    row = np.repeat(np.arange(len(train)), [len(at[k]) for k in train])
    # shares are small: scale each bucket by its spread over the documents
    spread = np.sqrt(np.bincount(cols, vals ** 2, BUCKETS) / len(train)) + 1e-4
    vals = vals / spread[cols]
    yt = y[train]
    # both classes weigh the same
    weight = np.where(yt > 0, 0.5 / yt.mean(), 0.5 / (1 - yt.mean()))
    norm = np.bincount(row, vals ** 2, len(train)).max()
    w, b, mw, mb = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS), 0.0
    rate = 4.0 / (norm + 1)
    for _ in range(STEPS):               # gradient steps with momentum
        z = np.bincount(row, vals * w[cols], len(train)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - yt)
        gw = np.bincount(cols, vals * g[row], BUCKETS) / len(train) + L2 * w
        mw, mb = 0.9 * mw - rate * gw * 10, 0.9 * mb - rate * g.mean() * 10
        w, b = w + mw, b + mb
    weights = (w / spread).astype(np.float32)
    score = np.array([b + float((weights[a].astype(np.float64) * s).sum()) for a, s in zip(at, share)])
    rows_c = np.flatnonzero(held) if held.any() else np.arange(len(y))
    slope, offset = _platt(score[rows_c], y[rows_c])
    return QualityModel(weights, float(b), slope, offset)


def _platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit, targets smoothed as Platt does."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.std(score)), 1e-9)
    x, a, c = score / scale, 1.0, 0.0
    for _ in range(100):                 # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -50, 50)))
        v = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - t) * x).sum() + 1e-3 * a, (p - t).sum()])
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
        d = np.linalg.solve(h, g)
        d = d / max(1.0, np.abs(d).max())
        a, c = a - d[0], c - d[1]
        if np.abs(d).max() < 1e-9:
            break
    return max(a, 1e-6) / scale, c


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge_quality(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD,
                  carry: list[str] | None = None) -> DataFrame:
    """Per row: the ``carry`` columns (default doc_id), the base counts,
    ``p_quality``, ``base_failed``, ``kept``."""
    carry = ["doc_id"] if carry is None else carry
    # positional names, so that input columns never clash with the added ones
    kept_cols = [F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]
    rows = documents.select(F.col("text").cast("binary").alias("t"),
                            F.coalesce(F.length("text"), F.lit(0)).alias("n"), *kept_cols)
    fields = rows.schema.fields[2:]
    schema = StructType(fields + [StructField(c, LongType()) for c in COUNTS] + [StructField("p_quality", DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.coalesce(pc.binary_length(batch.column(0)), 0).to_pylist()
            for start, end in chunked(lengths):
                part = batch.slice(start, end - start)
                texts = [x or b"" for x in part.column(0).to_pylist()]
                counts = base_counts(texts, part.column(1).to_pylist())
                cols = [*part.columns[2:], *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(model.probabilities(texts), pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[2:], *COUNTS, "p_quality"])

    out = rows.mapInArrow(judge, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(carry)], *COUNTS, "p_quality",
                      failed.alias("base_failed"), (~failed & (F.col("p_quality") >= threshold)).alias("kept"))
