"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripstream.config import ensure_checkpoint_dir, scratch_root, ship_package

# Words: runs of anything but ASCII space and \t \n \v \f \r (as bytes.split cuts).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# ASCII letters of F.translate (Unicode case rules play no part).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows of a few numbers that are broadcast at most (a few MB).
BROADCAST_ROWS = 100_000

#: Rows of a few numbers to a file, where a table's size is known before it is written.
FILE_ROWS = 1 << 14
LEAST_FILES = 8

#: Size of the sketch that says which rows are read again.
SKETCH_BITS = 23

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def ready(spark: SparkSession) -> None:
    """Shared scratch folder known, this package on the Python workers, and
    Arrow batches bounded by bytes (texts may be of any length)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def few_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows of a few numbers, in as many partitions as it needs:
    after a shuffle a small table lies in very many, each a task and a file. They grow with
    the rows; a table that fills the shuffle's partitions stays as it is."""
    parts = max(LEAST_FILES, -(-rows // FILE_ROWS))
    return df.coalesce(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def written(df: DataFrame, label: str, rows: int | None = None, **options) -> DataFrame:
    """``df`` written as Parquet under the shared scratch folder and read back:
    cuts the lineage, runs side effects once, and survives lost executors.
    ``rows``: about as many as it holds, if known (see ``few_parts``)."""
    spark = df.sparkSession
    if rows is not None:
        df = few_parts(df, rows)
    path = scratch_root(spark, label)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    for scope in _SCOPES:
        scope.paths[path] = out
    return out


class Scratch:
    """Tables that ``written`` made within a ``scratch_scope``."""

    def __init__(self) -> None:
        self.paths: dict[str, DataFrame] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave this table (as ``written`` returned it) where it is."""
        self.paths = {path: x for path, x in self.paths.items() if x is not df}
        return df


_SCOPES: list[Scratch] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Delete what ``written`` makes inside, but for what is kept, at the end. Nothing
    read after it may hang on a deleted table: keep a written result."""
    scope = Scratch()
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES.remove(scope)
        path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in scope.paths:
            p = path_of(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """``broadcast`` if the written table ``df`` has at most ``BROADCAST_ROWS`` rows
    (for parts of it, of a few numbers a row), else no hint."""
    return F.broadcast if df.count() <= BROADCAST_ROWS else lambda x: x


def row_key(df: DataFrame) -> Column:
    """A 64-bit identity of a row that is the same each time ``df`` is scanned.

    From file name and row index of a file scan; for other inputs the
    running id of the row in its partition.
    """
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        return F.monotonically_increasing_id()
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def lower_ascii(c) -> Column:
    return F.translate(c, UPPER, LOWER)


_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\v\f\r")] = True
_ODD = 0x100000001B3                     # base of the words' polynomial hash
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]   # of the base and of its inverse


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            for k, base in enumerate((_ODD, _ODD_INVERSE)):
                steps = np.full(size, np.uint64(base), np.uint64)
                steps[0] = 1
                _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each word of a byte array."""
    word = np.zeros(len(raw) + 2, np.int8)
    np.logical_not(_BLANK[raw], out=word[1:-1].view(bool))
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def place_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice: prefix sums of a polynomial over the bytes
    give all of them at once."""
    power, inverse = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(raw * power[:len(raw)] + power[:len(raw)], out=sums[1:])
        return mix64((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _M1)


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text cut between words, into pieces of about ``size`` bytes."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order."""
    out = []
    for piece in pieces(text):
        raw = np.frombuffer(piece, np.uint8)
        out.append(place_hashes(raw, *word_places(raw)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def chunked(lengths: Iterable[int], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``limit`` bytes together (a longer one alone)."""
    start, size, k = 0, 0, -1
    for k, n in enumerate(lengths):
        if k > start and size + n > limit:
            yield start, k
            start, size = k, 0
        size += n
    if k >= start:
        yield start, k + 1


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts, end to end, and where each text's begin
    (one more number: the end)."""
    if len(texts) == 1:
        one = word_hashes(texts[0])
        return one, np.array([0, len(one)])
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    start, end = word_places(raw)
    edges = np.cumsum([0] + [len(x) + 1 for x in texts])
    return place_hashes(raw, start, end), np.searchsorted(start, edges)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` words; with fewer words, of all of them as
    one window; of no words, nothing."""
    k = min(n, len(hashes))
    if k == 0:
        return hashes[:0]
    m = len(hashes) - k + 1
    with np.errstate(over="ignore"):
        s = np.full(m, np.uint64(k), np.uint64)
        for j in range(k):
            s = s * _M1 + hashes[j:j + m]
            s ^= s >> np.uint64(29)
    return mix64(s)


def shingle_set(text: bytes | None, n: int, lower: bool = True) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (null: none)."""
    if not text:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(text.lower() if lower else text), n))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def hashed_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches (texts as bytes in column 0), their word hashes
    with A-Z lower-cased, and where each text's begin."""
    for batch in batches:
        lengths = pc.coalesce(pc.binary_length(batch.column(0)), 0).to_pylist()
        for start, end in chunked(lengths):
            part = batch.slice(start, end - start)
            yield part, *hash_texts([(x or b"").lower() for x in part.column(0).to_pylist()])


def long_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 63-bit numbers as an Arrow column."""
    offsets = np.cumsum([0] + [len(x) for x in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).view(np.int64)))


def row_sketch(wanted: DataFrame) -> Callable[[pa.RecordBatch, int], pa.RecordBatch]:
    """A filter of batches that keeps all rows whose row_key (in the given column)
    is in ``wanted`` (column r), and some others.

    A bit sketch of a fixed 1 MB: it may only let more rows through, never fewer.
    """
    slot = F.pmod(F.col("r"), F.lit(1 << SKETCH_BITS))
    bits = (wanted.select(slot.alias("b")).groupBy(F.floor(F.col("b") / 64).cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(b % 64 AS INT))")).alias("v")).collect())
    sketch = np.zeros(1 << (SKETCH_BITS - 6), np.int64)
    sketch[[b["w"] for b in bits]] = [b["v"] for b in bits]
    hits: list[np.ndarray] = []

    def known(batch: pa.RecordBatch, column: int) -> pa.RecordBatch:
        if not hits:
            hits.append(np.unpackbits(sketch.view(np.uint8), bitorder="little"))
        slots = batch.column(column).to_numpy() & ((1 << SKETCH_BITS) - 1)
        return batch.filter(pa.array(hits[0][slots] == 1))

    return known


def wanted_texts(documents: DataFrame, wanted: DataFrame, tokens: Callable[[np.ndarray], np.ndarray],
                 text: str = "text") -> DataFrame:
    """``r, s``: ``tokens`` of the word hashes of documents by row_key, of all
    rows in ``wanted`` (column r) and some others.

    Texts are read where they are; a sketch of the wanted rows keeps most others
    from being hashed and shuffled.
    """
    known = row_sketch(wanted)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, at in hashed_texts(known(b, 1) for b in batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(1), long_lists([tokens(words[a:b]) for a, b in zip(at[:-1], at[1:])])], names=["r", "s"])

    rows = documents.select(F.col(text).cast("binary").alias("t"), row_key(documents).alias("r"))
    return rows.mapInArrow(make, "r long, s array<long>")
