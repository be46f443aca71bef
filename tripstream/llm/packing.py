"""Best-fit packing of tokenised documents into fixed-size sequences.

A document is its token ids and one end id. Documents longer than a sequence
are cut into full pieces and a rest; everything else stays whole. Full
pieces are sequences of their own. The others are dealt at random into groups
of about ``GROUP`` pieces, and each group is packed by itself:

1. best fit, longest piece first;
2. *swap-based local search* over the bins that are not full: a piece moves
   to a fuller bin, is exchanged for a shorter one of a fuller bin, or two
   pieces are exchanged for one, whenever that raises the sum of squared
   fills; bins that become empty are dropped.

Then the pieces of all bins that still are not full are dealt anew, over
fewer groups, and packed again (``ROUNDS`` in all), which gathers the
leftovers of the groups. Packing needs lengths only: a piece is one small
row, so a group is small whatever the documents are like, and no key can make
a group large (pieces are dealt by a hash of their row's place in the
written table).

Tokens come from the tokenizer file, one run of non-blank text at a time with
a bounded cache that the tasks of a Python worker share (the tokenizer never
looks across white space); a text never leaves its task.

Edge cases: null text -> empty; an empty text is the end id alone; repeated
rows are documents of their own; null doc_id stays null; empty table -> no
rows; other columns are ignored; a text of any length is cut.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripstream.llm.common import chunked, row_key, written

SEQUENCE = 2048
END_ID = 0
GROUP = 4096            # pieces a group, about
ROUNDS = 2
TRIES = 64              # fuller bins that a bin tries in a sweep
SWEEPS = 50
CACHE = 800_000         # runs of text in a generation of a worker's cache

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ASCII punctuation after a word, and such a word: the tokenizer cuts between the two.
_TAIL = b"!\"#$%&()*+,-./:;=?@[]^_`{}~"
_WORD = re.compile(rb"[a-z\x80-\xff]*[a-z]")
# Lower-case letters of Latin-1, composed: nothing to normalise, all one word.
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: a printable byte is its own letter, the others
    are letters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class IdCache:
    """Run of non-blank text (UTF-8) -> its token ids, as little-endian unsigned
    32-bit numbers. Two generations: when the young one is full it becomes
    the old one, and runs still in use move on."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _keep(self, parts: list[bytes], ids: list[int], ends: np.ndarray) -> None:
        data, at = np.array(ids, "<u4").tobytes(), 0
        for part, end in zip(parts, (4 * ends).tolist()):
            self.young[part] = data[at:end]
            at = end

    def _learn(self, runs: set[bytes]) -> None:
        """Unknown runs into the young generation. The model itself takes plain
        words; all else is encoded in one call (a token belongs to the part
        it starts in)."""
        young, old, words, rest, compound = self.young, self.old, [], [], []
        for run in runs:
            known = old.get(run)
            if known is not None:
                young[run] = known
                continue
            word = run.rstrip(_TAIL)
            plain = (word.isalpha() and word.islower()) or _LATIN.fullmatch(word)
            if len(word) == len(run):
                (words if plain else rest).append(run)
            elif (plain and word[-1] < 128) or _WORD.fullmatch(word):
                tail = run[len(word):]
                compound.append((run, word, tail))
                if word not in young:
                    (words if plain else rest).append(word)
                if tail not in young:
                    rest.append(tail)
            else:
                rest.append(run)
        if words:
            words = list(dict.fromkeys(words))
            found = [self.model.tokenize(x.decode() if x.isascii() else x.decode("latin-1").translate(_LETTERS))
                     for x in words]
            self._keep(words, [t.id for x in found for t in x], np.cumsum([len(x) for x in found]))
        if rest:
            rest = list(dict.fromkeys(rest))
            text = b"\n".join(rest).decode()
            e = self.tokenizer.encode(text, add_special_tokens=False)
            first = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
            edges = np.cumsum(np.fromiter((len(x) + 1 for x in text.split("\n")), np.int64))
            self._keep(rest, e.ids, np.searchsorted(first, edges))
        for run, word, tail in compound:
            young[run] = young[word] + young[tail]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        # A-Z are lower-cased by the tokenizer anyway, but special tokens are
        # known in their own spelling only; ASCII blanks are among its white space
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        get = self.young.get
        found = [list(map(get, runs)) for runs in split]
        unknown = {r for runs, ids in zip(split, found) if None in ids for r, x in zip(runs, ids) if x is None}
        if len(self.young) + len(unknown) > CACHE:
            self.old, self.young = self.young, {}
        if unknown:
            self._learn(unknown)
        get = self.young.get
        for runs, ids in zip(split, found):
            yield b"".join(ids if None not in ids else [get(r) if x is None else x for r, x in zip(runs, ids)])


@lru_cache(maxsize=1)
def id_cache(path: str) -> IdCache:
    """The cache of a Python worker, which its tasks share one after the other."""
    return IdCache(path)


def token_pieces(documents: DataFrame, path: str, size: int = SEQUENCE, doc_id: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids_crc32`` (and ``ids``)."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"),
                            F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = id_cache(path)
        for batch in batches:
            for first, last in chunked(pc.binary_length(batch.column(1)).to_pylist()):
                part, out = batch.slice(first, last - first), []
                for doc, data in zip(part.column(0).to_pylist(), cache.encode(part.column(1).to_pylist())):
                    data += end
                    for k, a in enumerate(range(0, len(data), 4 * size)):
                        ids = data[a:a + 4 * size]
                        row = (doc, k, a // 4, len(ids) // 4, zlib.crc32(ids))
                        out.append((*row, ids) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of piece numbers: longest piece first, each into the fullest bin it fits."""
    room: dict[int, list[int]] = {}     # free places -> bins that have just that
    free = 0                            # the same as a bit set
    bins: list[list[int]] = []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        fits = free >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                free &= ~(1 << left)
        else:
            b, left = len(bins), size
            bins.append([])
        bins[b].append(k)
        left -= n
        if left:
            room.setdefault(left, []).append(b)
            free |= 1 << left
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Move and exchange pieces between bins that are not full.

    Each step takes places from a bin and gives them to one that is at least
    as full, so the sum of squared fills rises with every step (by whole
    numbers, below a bound): the search ends. A bin tries the ``TRIES`` fullest
    others at a time, which bounds the effort of a sweep.
    """
    n = lengths.tolist()
    # a bin: length -> its pieces of that length
    held = []
    for b in bins:
        by: dict[int, list[int]] = {}
        for k in b:
            by.setdefault(n[k], []).append(k)
        held.append(by)
    fill = [sum(n[k] for k in b) for b in bins]
    loose = list(range(len(bins)))
    for _ in range(SWEEPS):
        loose = sorted((b for b in loose if 0 < fill[b] < size), key=lambda b: fill[b])
        improved = False
        for a in loose:                          # give away from the emptiest
            for b in loose[-TRIES:][::-1]:       # to the fullest
                while b != a and 0 < fill[a] <= fill[b] < size and _shift(held, fill, a, b, size):
                    improved = True
        if not improved:
            break
    return [[k for same in by.values() for k in same] for by in held if by]


def _shift(held: list[dict], fill: list[int], a: int, b: int, size: int) -> bool:
    """Best single step that makes bin b fuller at the expense of bin a."""
    gap = size - fill[b]
    mine, theirs = held[a], held[b]
    best, step = 0, None
    for x in mine:                               # move
        if best < x <= gap:
            best, step = x, ((x,), ())
    if best < gap:                               # one for one
        for x in mine:
            for y in theirs:
                if best < x - y <= gap:
                    best, step = x - y, ((x,), (y,))
    if best < gap:                               # two for one
        for x, same in mine.items():
            for z in mine:
                if z < x or (z == x and len(same) > 1):
                    for y in theirs:
                        if best < x + z - y <= gap:
                            best, step = x + z - y, ((x, z), (y,))
    if step is None:
        return False
    for xs, source, target in ((step[0], mine, theirs), (step[1], theirs, mine)):
        for x in xs:
            target.setdefault(x, []).append(source[x].pop())
            if not source[x]:
                del source[x]
    fill[a] -= best
    fill[b] += best
    return True


def pack_group(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and whether the bin is full, of each piece."""
    bins = local_search(best_fit(lengths, size), lengths, size)
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = np.zeros(len(lengths), bool)
    for b, members in enumerate(bins):
        at = 0
        for k in members:
            where[k], offset[k] = b, at
            at += int(lengths[k])
        full[members] = at == size
    return where, offset, full


_PACKED = PIECE_SCHEMA + ", round int, grp long, bin long, offset long, full boolean"


def _pack_round(pieces: DataFrame, size: int, turn: int) -> DataFrame:
    """Deal the pieces of a written table into groups and pack each group."""
    groups = max(1, -(-pieces.count() // GROUP))
    names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
    dealt = pieces.select(*names, F.pmod(F.hash(row_key(pieces), F.lit(turn)), F.lit(groups)).cast("long").alias("grp"),
                          row_key(pieces).alias("row"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=False, ignore_index=True)
        where, offset, full = pack_group(pdf["length"].to_numpy(), size)
        return pdf.drop(columns="row").assign(round=np.int32(turn), bin=where, offset=offset, full=full)

    return written(dealt.groupBy("grp").applyInPandas(pack, _PACKED), f"packed-{turn}")


def pack_documents(documents: DataFrame, path: str | None = None, size: int = SEQUENCE,
                   rounds: int = ROUNDS, **columns) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece."""
    path = tokenizer_path() if path is None else path
    pieces = written(token_pieces(documents, path, size, **columns), "pieces")
    names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
    # full pieces: sequences of their own, numbered downwards from -1
    out = pieces.where(F.col("length") == size).select(
        *names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    loose = pieces.where(F.col("length") < size)
    for turn in range(rounds):
        packed = _pack_round(loose, size, turn)
        done = packed if turn == rounds - 1 else packed.where("full")
        sequence = F.shiftleft("grp", 16) * rounds + F.shiftleft(F.col("round").cast("long"), 16) + F.col("bin")
        out = out.unionByName(done.select(*names, sequence.alias("sequence_id"), "offset"))
        loose = packed.where(~F.col("full"))
    return out
