"""Benchmark decontamination: size-partitioned MinHash containment search.

Which test items are contained in which documents: at least ``CONTAINMENT``
of an item's distinct five-word shingles occur in the document.

The short side is the query. Each document is cut into *segments* of 64
shingles that overlap by half; an item into parts of at most 32 shingles, so
an item's part that stands unbroken in a document lies inside one segment (a
scattered item is met by whichever of its minima a segment holds; the tests have
items in chunks of 6 to 60 words, all found). Segments
are *partitioned by size*: an item part of q shingles contained to a share t
in a segment of at most u shingles has a Jaccard similarity of at least
``t q / (u + q - t q)``, and each size partition uses as many hash functions
as find such a pair with probability ``1 - MISS``. A segment that shares one
minimum with an item part makes a candidate, and every candidate is verified
by exact containment of the whole item in the whole document. Items too short
for that (fewer than ``TINY`` shingles) are searched by each of their
shingles instead of minima, which misses none.

Documents are never shuffled: items go to the tasks in blocks of at most
``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words, one pass over the
documents per block.

Words are runs without ASCII white space, with A-Z lower-cased.

Edge cases: null or empty text, or fewer words than a shingle -> contains no
item, and an item of that kind is in no document; null ids are kept; repeated
items and documents are reported one by one; empty tables -> no pairs; extra
columns are ignored (``clean`` carries them through, whatever their names).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripstream.llm.common import hash_texts, hashed_texts, mix64, shared, shingle_hashes

SHINGLE = 5
CONTAINMENT = 0.8
SEGMENT = 64            # shingles a segment; half of it from one to the next
PART = 32               # shingles an item part at most
SIZES = (16, 32, 64)    # upper bounds of the size partitions
MISS = 1e-6
TINY = 8
BLOCK_ITEMS = 4096      # bounds what goes to the tasks at once
BLOCK_WORDS = 1 << 20
_FILTER_BITS = 20


def hash_functions(n: int) -> np.ndarray:
    """Odd multipliers of multiply-shift hashing."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def hashes_needed(q: int, u: int, t: float = CONTAINMENT, miss: float = MISS) -> int:
    """Hash functions that find an item part of q shingles in a segment of u."""
    jaccard = min(1.0, t * q / max(1.0, u + q - t * q))
    return 1 if jaccard >= 1 else math.ceil(math.log(miss) / math.log1p(-jaccard))


@dataclass
class ItemBlock:
    """Items as the tasks see them: shingle sets, and minima of their parts."""

    ids: list
    sets: list[np.ndarray] = field(default_factory=list)
    keys: np.ndarray | None = None       # sorted minima (or shingles of tiny items)
    owners: np.ndarray | None = None     # the item of each
    functions: list[int] = field(default_factory=list)   # hash functions per size partition
    tiny: bool = False

    @classmethod
    def build(cls, rows: list[tuple]) -> ItemBlock:
        block, parts, tiny = cls([i for i, _ in rows]), [], []
        for k, (_, text) in enumerate(rows):
            words, _ = hash_texts([(text or "").encode().lower()])
            grams = shingle_hashes(words, SHINGLE) if len(words) >= SHINGLE else words[:0]
            block.sets.append(np.unique(grams))
            if 0 < len(block.sets[-1]) < TINY:
                tiny.append((k, block.sets[-1]))
            elif len(grams):
                n = math.ceil(len(grams) / PART)
                parts += [(k, x) for x in np.array_split(grams, n)]
        # a part's distinct shingles may be few (a repeated phrase): searched one by one as well
        tiny += [(k, np.unique(x)) for k, x in parts if len(np.unique(x)) < TINY]
        parts = [(k, x) for k, x in parts if len(np.unique(x)) >= TINY]
        least = min((len(np.unique(x)) for _, x in parts), default=PART)
        block.functions = [hashes_needed(least, u) for u in SIZES] if parts else [0] * len(SIZES)
        seeds = hash_functions(max(block.functions))
        keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for k, x in parts:
            with np.errstate(over="ignore"):
                keys.append((x[:, None] * seeds).min(axis=0) if len(seeds) else seeds)
            owners.append(np.full(len(seeds), k))
        for k, x in tiny:
            keys.append(x)
            owners.append(np.full(len(x), k))
        block.tiny = bool(tiny)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        block.keys, block.owners = keys[order], owners[order]
        return block


class ItemSearch:
    """Candidates and exact containments of a block, one document at a time."""

    def __init__(self, block: ItemBlock):
        self.block = block
        self.seeds = hash_functions(max(block.functions, default=0))
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)     # by the keys' top bits
        self.maybe[(block.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def _owners(self, values: np.ndarray) -> np.ndarray:
        values = values[self.maybe[(values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]]
        lo = np.searchsorted(self.block.keys, values, "left")
        hi = np.searchsorted(self.block.keys, values, "right")
        runs = [self.block.owners[a:b] for a, b in zip(lo[lo < hi], hi[lo < hi])]
        return np.unique(np.concatenate(runs)) if runs else np.empty(0, np.int64)

    def find(self, grams: np.ndarray) -> list[tuple[int, int]]:
        """``(item, shared shingles)`` of the items contained in a document,
        given its shingles in order."""
        n = len(grams)
        if not n:
            return []
        half = SEGMENT // 2
        values = []
        if len(self.seeds):
            # minima of half segments; a segment's are those of two neighbours
            starts = np.arange(0, n, half)
            size = np.minimum(n - starts, SEGMENT)
            if len(starts) > 1:
                starts, size = starts[:-1], size[:-1]
            for u, lower, used in zip(SIZES, (0, *SIZES), self.block.functions):
                mine = (size > lower) & (size <= u)
                if mine.any():
                    a, b = starts[mine][0], starts[mine][-1] + half
                    values.append(self._minima(grams[a:min(n, b + half)], half, used))
        if self.block.tiny:
            values.append(grams)
        hits = self._owners(np.concatenate(values)) if values else []
        if not len(hits):
            return []
        whole, out = np.unique(grams), []
        for k in hits:
            item = self.block.sets[k]
            n_shared = shared(item, whole)
            if n_shared >= CONTAINMENT * len(item) - 1e-9:
                out.append((int(k), n_shared))
        return out

    def _minima(self, grams: np.ndarray, half: int, used: int) -> np.ndarray:
        at = np.arange(0, len(grams), half)
        rows = 1 << 14                   # bounds the table of hashes
        out = []
        for k in range(0, len(at), rows // half):
            mine = at[k:k + rows // half + 1]
            end = min(len(grams), mine[-1] + half)
            with np.errstate(over="ignore"):
                table = grams[mine[0]:end, None] * self.seeds[:used]
            low = np.minimum.reduceat(table, mine - mine[0], axis=0)
            out.append(low if len(low) == 1 else np.minimum(low[:-1], low[1:]))
        return np.concatenate(out).ravel()


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[ItemBlock]:
    """The items in blocks of bounded size, read partition by partition."""
    rows, size = [], 0
    for r in items.select(F.col(item_id).cast("long"), F.col(text)).toLocalIterator():
        n = len(r[1] or "") // 2 + 1     # words at most
        if rows and (len(rows) >= BLOCK_ITEMS or size + n > BLOCK_WORDS):
            yield ItemBlock.build(rows)
            rows, size = [], 0
        rows.append((r[0], r[1]))
        size += n
    if rows:
        yield ItemBlock.build(rows)


def _found(search: ItemSearch, words: np.ndarray, at: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    for a, b in zip(at[:-1], at[1:]):
        mine = words[a:b]
        yield search.find(shingle_hashes(mine, SHINGLE)) if len(mine) >= SHINGLE else []


def contained_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared``: the item's distinct
    shingles, and those of them in the document."""
    schema = "doc_id long, item_id long, n_item long, n_shared long"
    docs = documents.select(F.col(text).cast("binary").alias("t"), F.col(doc_id).cast("long").alias("doc_id"))
    out = None
    for block in item_blocks(items):
        def find(batches: Iterator[pa.RecordBatch], block: ItemBlock = block) -> Iterator[pa.RecordBatch]:
            search = ItemSearch(block)
            for part, words, at in hashed_texts(batches):
                rows = [(doc, block.ids[k], len(block.sets[k]), n)
                        for doc, hits in zip(part.column(1).to_pylist(), _found(search, words, at))
                        for k, n in hits]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     names=["doc_id", "item_id", "n_item", "n_shared"])

        pairs = docs.mapInArrow(find, schema)
        out = pairs if out is None else out.unionByName(pairs)
    return documents.sparkSession.createDataFrame([], schema) if out is None else out


def clean(documents: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents (all columns) that contain no item."""
    out = documents
    for block in item_blocks(items):
        def keep(batches: Iterator[pa.RecordBatch], block: ItemBlock = block) -> Iterator[pa.RecordBatch]:
            search = ItemSearch(block)
            for part, words, at in hashed_texts(batches):
                mask = pa.array([not hits for hits in _found(search, words, at)], pa.bool_())
                yield pa.RecordBatch.from_arrays(part.columns[1:], names=part.schema.names[1:]).filter(mask)

        # positional names, so that no column of the input clashes with the text's bytes
        cols = out.columns
        rows = out.select(F.col(f"`{text}`").cast("binary").alias("t"),
                          *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(cols)])
        out = rows.mapInArrow(keep, rows.drop("t").schema).toDF(*cols)
    return out
