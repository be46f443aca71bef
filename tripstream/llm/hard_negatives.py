"""Hard-negative mining over embeddings, exact, by one-bit codes.

*Index*: each vector is rotated by a fixed random rotation and kept as the signs
of its components (one bit each), its norm, and its *alignment*: the cosine
between the rotated vector and its code ``b`` (a unit vector of +-1/sqrt(d)).
*Estimate*: an anchor ``q`` is rotated too and cut into bit planes, so that
``<b, q>`` is a sum of popcounts, off by the norm of what the planes leave out
at most. *Interval*: ``x = |x| (a b + sqrt(1 - a^2) r)`` with r a unit vector
across b, and by Cauchy-Schwarz ``|<r, q>| <= sqrt(|q|^2 - <b, q>^2)``: a sure
interval around the score, no chance in it. Pairs whose interval cannot
reach the places or the window that count are left out; the others are
*scored* by their integer inner product. So the result is that of scoring
all pairs.

The anchors are the query set. They meet all rows in blocks of bounded size
(``BLOCK_BYTES``), each block sent to the tasks once a pass; the rows are read
where they are, in tiles. A first pass finds each anchor's positives, a second
one the negatives in each positive's window. A task gives back at most k rows
for each anchor (or positive), so what is shuffled does not grow with pairs.

Edge cases: rows with null vec_id, label, vector or component, or with a
component that is not finite, take no part; vectors of unlike length meet as if
the shorter had zeros behind; components beyond 64 bits are cut to them, and so
are scores; rows that repeat a vec_id are rows of their own, and equal ones
are one anchor; an anchor's positives and negatives have another vec_id; ties
go to the smaller vec_id; empty table -> no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tripstream.llm.common import ready, written

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95               # percent of the positive's score that a negative's may be

PLANES = 6                       # bits of an anchor's component in the estimate
BLOCK_BYTES = 16 << 20           # of anchors sent to the tasks at once
TILE_ROWS, TILE_ANCHORS = 1024, 512
TASK_PAIRS = 1 << 27             # pairs a task has about, at least
SEED = 20240613

_SLACK = 1e-9                    # of |x| |q|: beyond the rounding of the estimates
_LARGE = 2.0 ** 62


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A fixed random rotation of ``d`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words, zeros behind."""
    words = -(-bits.shape[1] // 64)
    wide = np.zeros((len(bits), words * 64), bool)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """Vectors (integers), their one-bit codes, norms and alignments."""

    vectors: np.ndarray
    words: np.ndarray
    norm: np.ndarray
    align: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, turn: np.ndarray) -> "Codes":
        y = vectors.astype(np.float64) @ turn.T
        norm = np.sqrt((y * y).sum(axis=1))
        align = np.abs(y).sum(axis=1) / np.maximum(norm, 1e-300) / np.sqrt(y.shape[1])
        return cls(vectors, _packed(y > 0), norm, np.where(norm > 0, np.minimum(align, 1.0), 1.0))


@dataclass
class Queries:
    """Anchors of a block: ids, labels, integer vectors and bit planes."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    planes: np.ndarray           # plane, anchor, word
    base: np.ndarray             # <b, q> is about base + low * popcount(b) + step * planes
    low: np.ndarray
    step: np.ndarray
    left: np.ndarray             # norm of what the planes leave out
    norm: np.ndarray

    @classmethod
    def of(cls, ids, labels, vectors, turn) -> "Queries":
        y = vectors.astype(np.float64) @ turn.T
        low = y.min(axis=1)
        step = np.maximum((y.max(axis=1) - low) / ((1 << PLANES) - 1), 1e-300)
        u = np.rint((y - low[:, None]) / step[:, None]).astype(np.int64)
        got = low[:, None] + step[:, None] * u
        planes = np.stack([_packed((u >> j & 1) > 0) for j in range(PLANES)])
        root = np.sqrt(y.shape[1])
        return cls(ids, labels, vectors, planes, -got.sum(axis=1) / root, 2 * low / root, 2 * step / root,
                   np.sqrt(((y - got) ** 2).sum(axis=1)), np.sqrt((y * y).sum(axis=1)))


def intervals(rows: Codes, r: slice | np.ndarray, q: Queries, a: slice | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each row of ``r`` can have with each anchor of ``a``."""
    words = rows.words[r]
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(np.float64)
    count = np.zeros((len(words), len(q.ids[a])))
    for j in range(PLANES):
        n = np.zeros(count.shape, np.uint16)
        for w in range(words.shape[1]):
            n += np.bitwise_count(words[:, w, None] & q.planes[j, a, w][None, :])
        count += n * float(1 << j)
    near = q.base[a] + ones[:, None] * q.low[a] + count * q.step[a]
    left, size = q.left[a], q.norm[a]
    # the largest |<r, q>| belongs to the smallest |<b, q>| that the planes allow
    least = np.maximum(np.abs(near) - left, 0)
    across = np.sqrt(np.maximum(size * size - least * least, 0))
    align = rows.align[r][:, None]
    around = align * left + np.sqrt(np.maximum(1 - align * align, 0)) * across + _SLACK * size
    middle, norm = align * near, rows.norm[r][:, None]
    return norm * (middle - around), norm * (middle + around)


def scores(rows: Codes, r: np.ndarray, q: Queries, a: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs (row, anchor)."""
    out = np.empty(len(r), np.int64)
    for s in range(0, len(r), 1 << 15):
        x, y = rows.vectors[r[s:s + (1 << 15)]], q.vectors[a[s:s + (1 << 15)]]
        out[s:s + (1 << 15)] = np.einsum("ij,ij->i", x, y)
    for k in np.flatnonzero(rows.norm[r] * q.norm[a] >= _LARGE):      # beyond 64 bits on the way
        exact = sum(int(u) * int(v) for u, v in zip(rows.vectors[r[k]], q.vectors[a[k]]))
        out[k] = max(-(1 << 63), min((1 << 63) - 1, exact))
    return out


class Best:
    """The first ``k`` (score descending, id ascending) of each of ``n`` slots."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.slot = self.score = self.id = np.empty(0, np.int64)
        self.bar = np.full(n, -np.inf)     # score of a full slot's last

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, slot))        # ~x falls as x rises, without overflow
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        last = place[keep] == self.k - 1
        self.bar[self.slot[last]] = self.score[last]


def _tiles(n: int, size: int) -> Iterator[slice]:
    for s in range(0, n, size):
        yield slice(s, min(n, s + size))


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, Codes]:
    ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    raw = [np.frombuffer(b"".join(batch.column(k).to_pylist()), kind).reshape(len(ids), -1)
           for k, kind in ((2, np.int64), (3, np.uint64))]
    return ids, labels, Codes(*raw, batch.column(4).to_numpy(), batch.column(5).to_numpy())


_INDEX = "vec_id long, label int, vector binary, code binary, norm double, align double"
_FOUND = "slot long, score long, id long"


def _found(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (best.slot, best.score, best.id)],
                                      names=["slot", "score", "id"])


def index_vectors(vectors: DataFrame, d: int, turn: np.ndarray) -> DataFrame:
    """The index of rows (vec_id, label, v: array<long>)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            flat, at = v.flatten().to_numpy(), v.offsets.to_numpy()
            n = np.diff(at)
            wide = np.zeros((len(n), d), np.int64)
            row = np.repeat(np.arange(len(n)), n)
            wide[row, np.arange(len(flat)) - np.repeat(at[:-1] - at[0], n)] = flat
            c = Codes.of(wide, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in c.vectors], pa.binary()),
                 pa.array([x.tobytes() for x in c.words], pa.binary()), pa.array(c.norm), pa.array(c.align)],
                names=[x.split()[0] for x in _INDEX.split(", ")])

    return vectors.select("vec_id", "label", "v").mapInArrow(code, _INDEX)


def _best(index: DataFrame, n: int, k: int, search) -> DataFrame:
    """``slot, score, id, place`` (from 1): the first k of each slot over all
    tasks; ``search(ids, labels, codes, best)`` adds what a batch holds."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n, k)
        for batch in batches:
            if batch.num_rows:
                search(*_codes(batch), best)
        yield _found(best)

    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    return (index.mapInArrow(walk, _FOUND).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k))


def _positives(q: Queries):
    by_label = {x: np.flatnonzero(q.labels == x) for x in np.unique(q.labels)}

    def search(ids, labels, rows, best):
        for label in np.unique(labels):
            mine, theirs = np.flatnonzero(labels == label), by_label.get(label, ())
            for t in _tiles(len(mine), TILE_ROWS):
                for s in _tiles(len(theirs), TILE_ANCHORS):
                    r, a = mine[t], theirs[s]
                    _, most = intervals(rows, r, q, a)
                    i, j = np.nonzero((most >= best.bar[a]) & (ids[r][:, None] != q.ids[a]))
                    best.add(a[j], scores(rows, r[i], q, a[j]), ids[r[i]])

    return search


def _negatives(q: Queries, at: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Slots are the anchors' positives: ``at[slot, 0]`` the anchor, its slots side by
    side (``at[anchor, 1]`` of them from ``at[anchor, 0]``), windows low..high."""
    def search(ids, labels, rows, best):
        for t in _tiles(len(ids), TILE_ROWS):
            r = np.arange(t.start, t.stop)
            for s in _tiles(len(q.ids), TILE_ANCHORS):
                a = np.arange(s.start, s.stop)
                least, most = intervals(rows, t, q, s)
                other = (labels[t][:, None] != q.labels[s]) & (ids[t][:, None] != q.ids[s])
                width = int(at[s, 1].max(initial=0))
                wanted = np.zeros(least.shape, bool)
                for k in range(width):
                    slot = at[s, 0] + k
                    real = k < at[s, 1]
                    slot = np.where(real, slot, 0)
                    floor = np.maximum(low[slot], best.bar[slot])
                    wanted |= real & (most >= floor) & (least <= high[slot])
                i, j = np.nonzero(wanted & other)
                got = scores(rows, r[i], q, a[j])
                for k in range(width):
                    slot = at[a[j], 0] + k
                    ok = k < at[a[j], 1]
                    slot = np.where(ok, slot, 0)
                    ok &= (got >= low[slot]) & (got <= high[slot])
                    best.add(slot[ok], got[ok], ids[r[i[ok]]])

    return search


def mine_negatives(embeddings: DataFrame, anchors: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``
    of rows (vec_id, embedding, label); anchors are the rows whose vec_id is
    divisible by ``anchors``. A negative's score is from ``low`` to ``high`` percent
    of the positive's."""
    spark = embeddings.sparkSession
    ready(spark)
    real = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                              F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & real)
            .select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * 256).cast("long")).alias("v")))
    size = rows.agg(F.max(F.size("v")), F.count(F.lit(1)),
                    F.count_if(F.col("vec_id") % anchors == 0)).first()
    d, total, asked = max(1, size[0] or 1), size[1], size[2]
    turn = rotation(d)
    blocks = max(1, -(-asked * d * 16 // block_bytes))
    tasks = max(1, total * -(-asked // blocks) // TASK_PAIRS)
    index = index_vectors(rows, d, turn)
    if tasks > spark.sparkContext.defaultParallelism:
        index = index.repartition(tasks)
    index = written(index, "hard-negatives", compression="zstd")
    own = (index.where(F.col("vec_id") % anchors == 0).select("vec_id", "label", "vector").distinct()
           .withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks))))
    if blocks > 1:
        own = written(own.repartition("block"), "hard-negatives-anchors", partitionBy="block")
    out = [_block(spark, index, own.where(F.col("block") == b), d, turn, positives, negatives, low, high)
           for b in range(blocks)]
    out = [x for x in out if x is not None]
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def _block(spark, index: DataFrame, own: DataFrame, d: int, turn, positives, negatives, low, high) -> DataFrame | None:
    """Of a block of anchors: positives, then their negatives."""
    got = own.select("vec_id", "label", "vector").toArrow().combine_chunks().to_pydict()
    if not got["vec_id"]:
        return None
    order = sorted(range(len(got["vec_id"])), key=lambda k: (got["vec_id"][k], got["label"][k], got["vector"][k]))
    ids, labels = (np.array([got[c][k] for k in order], np.int64) for c in ("vec_id", "label"))
    vectors = np.frombuffer(b"".join(got["vector"][k] for k in order), np.int64).reshape(-1, d)
    q = Queries.of(ids, labels, vectors, turn)
    found = _best(index, len(ids), positives, _sent(spark, q, _positives)).toArrow().to_pydict()
    rank = np.lexsort((found["place"], found["slot"]))
    anchor, p_score, p_id = (np.array(found[c], np.int64)[rank] for c in ("slot", "score", "id"))
    if not len(anchor):
        return None
    n = np.bincount(anchor, minlength=len(ids))
    at = np.stack([np.cumsum(n) - n, n], axis=1)
    # 100 * score between low and high percent, in whole numbers
    least = np.array([-(-low * int(s) // 100) for s in p_score], np.int64)
    most = np.array([high * int(s) // 100 for s in p_score], np.int64)
    best = _best(index, len(anchor), negatives, _sent(spark, (q, at, least, most), lambda x: _negatives(*x)))
    slots = spark.createDataFrame(
        pa.table({"slot": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": p_id, "positive_score": p_score}))
    # the slots of one block: bounded like the block itself
    return best.join(F.broadcast(slots), "slot").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def _sent(spark, data, make):
    """A search whose block of anchors is broadcast, and unpacked once in a task."""
    box, held = spark.sparkContext.broadcast(data), []

    def search(ids, labels, rows, best):
        if not held:
            held.append(make(box.value))
        held[0](ids, labels, rows, best)

    return search
