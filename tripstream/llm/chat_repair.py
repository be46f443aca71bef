"""Conversation structure repair: the cheapest edits that make turns alternate.

The rows of a conversation, by turn, are kept, given another role, deleted, or
joined by inserted empty rows, until their role initials read ``(s?(ua)+)?``.

*Secondary sort*: one shuffle by conversation; faults that look back over the
conversation (a role and text seen earlier) are marked by a window inside that
partitioning, then each partition is sorted by conversation and turn, both in
the JVM, which spills. *Streaming*: ``mapInPandas`` walks the sorted rows
and carries the state of a dynamic program over batches: for each of the four
places in the pattern (start, after s, after u, after a) the least cost, the
rank of its edit string among the four (ties go to the ASCII-least string),
and a running SHA-256 of its repaired rows. Costs are kept relative to the
least one and differ by 5 at most, so the program has few distinct states; each
step between two of them is worked out once and then looked up. No text is kept after its row.

*Backpointers*: four bytes a row say which place each best edit string came
from and by what edit. When a conversation holds ``SPILL_ROWS`` of them they
leave the task as a row of the output, so that a giant conversation never
fills a task; such conversations are traced back in a second pass, block by
block from their end, and their audit pieces put together. The first pass is
written to the shared folder, so a lost executor repeats its tasks only.

Costs: Keep 0, Rerole 2, Delete 3, Insert 2, an undeleted truncated row 1 more.

Edge cases: null role or text is one space; a null turn sorts first and does
not count for gaps; null conv_id is a conversation of its own; rows of one turn are
ordered by role and text, so ties and repeated rows have one order; a role that
starts with none of s, u, a (or is empty) cannot be kept; a conversation of
which no row is left has zeros, an empty audit and the hash of the empty string;
empty table -> no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tripstream.llm.common import ready, written

SPILL_ROWS = 1 << 20      # backpointers (4 bytes each) a task holds of one conversation

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

BLANKS = " \t\n\x0b\x0c\r"

# Places in the pattern (s?(ua)+)?: start, after s, after u, after a.
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_NEXT = {_START: {"s": _AFTER_S, "u": _AFTER_U}, _AFTER_S: {"u": _AFTER_U},
         _AFTER_U: {"a": _AFTER_A}, _AFTER_A: {"u": _AFTER_U}}
_INSERTED = {_START: "u", _AFTER_S: "u", _AFTER_U: "a", _AFTER_A: "u"}     # the only row that fits there
_ENDS = (_START, _AFTER_A)
_ROLES = {"u": "user", "a": "assistant"}
_NONE = 255                # no way to this place
_MOST_INSERTS = 2          # three lead back to where one did
# What one place costs more than another to go on from: after u, "a" inserted (2)
# and a kept s deleted (3). A place that is dearer by more is never on the best way.
_MOST_APART = INSERT + DELETE

_SCHEMA = ("conv_id long, block long, gaps long, blank long, duplicate long, truncated long, illegal long, "
           "cost long, audit string, repaired_sha256 string, place int, steps binary")


def damaged(chats: DataFrame) -> DataFrame:
    """The rows after damage by ``crc32(conv_id:turn) % 20``: 0 drops the row
    (kept with ``gone`` set, so that its conversation stays known), 1 empties its
    text, 2 removes ``.!?``, 3 repeats it, 4 sets its role to user."""
    space = F.lit(" ")
    rows = chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", F.crc32(key.cast("binary")) % 20)
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone, fault`` of rows (conv_id, turn, role,
    text, gone), each conversation in one partition and in order there.
    fault: 1 blank, 2 duplicate, 3 truncated, 0 none; the first that holds."""
    spot = rows.repartition("conv_id")
    # inside the shuffle by conversation: no other exchange
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    solid = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(solid == "", 1).when(F.row_number().over(same) > 1, 2)
             .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0))
    return (spot.select("*", fault.alias("fault"))
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
            # numbers with nulls would become floats on the way to pandas
            .select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "gone", "fault"))


def _edits(place: int, initial: str, must_go: bool, cut_off: bool) -> Iterator[tuple[str, int, int]]:
    """Edit string, place after it, and cost of each way to take in one row."""
    at, inserts, extra = place, "", TRUNCATED if cut_off else 0
    for n in range(_MOST_INSERTS + 1):
        cost = n * INSERT
        yield inserts + "D", at, cost + DELETE
        if not must_go:
            if initial in _NEXT[at]:
                yield inserts + "K", _NEXT[at][initial], cost + KEEP + extra
            for x in _ROLES:
                if x in _NEXT[at]:
                    yield inserts + "R", _NEXT[at][x], cost + REROLE + extra
        at, inserts = _NEXT[at][_INSERTED[at]], inserts + "I"


class Steps:
    """Steps of the dynamic program, each worked out once.

    A state is four pairs (cost above the least, rank) or None, by place. A step
    is the next state, by how much the least cost rises, and by place
    ``(place before, inserts, edit)`` or None, plus these as four bytes.
    """

    first = ((0, 0), None, None, None)

    def __init__(self) -> None:
        self.known: dict = {}
        self.ends: dict = {}

    def step(self, state: tuple, initial: str, must_go: bool, cut_off: bool) -> tuple:
        key = (state, initial, must_go, cut_off)
        if key not in self.known:
            self.known[key] = self._work_out(*key)
        return self.known[key]

    @staticmethod
    def _work_out(state, initial, must_go, cut_off):
        best: list = [None] * 4
        for place, had in enumerate(state):
            if had is None:
                continue
            for edits, to, cost in _edits(place, initial, must_go, cut_off):
                # edit strings of two places after the same rows are never a
                # beginning of each other: their ranks order whatever follows
                way = (had[0] + cost, had[1], edits, place)
                if best[to] is None or way < best[to]:
                    best[to] = way
        least = min(x[0] for x in best if x)
        best = [x if x and x[0] <= least + _MOST_APART else None for x in best]
        order = sorted((x[1], x[2], to) for to, x in enumerate(best) if x)
        rank = {to: k for k, (_, _, to) in enumerate(order)}
        after = tuple(x and (x[0] - least, rank[to]) for to, x in enumerate(best))
        back = tuple(x and (x[3], len(x[2]) - 1, x[2][-1]) for x in best)
        packed = bytes(_NONE if x is None else x[0] * 16 + x[1] * 4 + "DKR".index(x[2]) for x in back)
        return after, least, back, packed

    def end(self, state: tuple) -> tuple[int, int, int]:
        """Cost above the least, place, and inserts of the cheapest ending."""
        if state not in self.ends:
            ways = []
            for place, had in enumerate(state):
                at, n = place, 0
                while had and n <= _MOST_INSERTS:
                    if at in _ENDS:
                        ways.append((had[0] + n * INSERT, had[1], n, place))
                    at, n = _NEXT[at][_INSERTED[at]], n + 1
            cost, _, n, place = min(ways)
            self.ends[state] = cost, place, n
        return self.ends[state]


def _trace(steps: np.ndarray, place: int) -> tuple[str, int]:
    """Edit string of a run of rows that ends at ``place``, and where it begins."""
    out = []
    for row in steps[::-1]:
        x = int(row[place])
        out.append("I" * (x // 4 % 4) + "DKR"[x % 4])
        place = x // 16
    return "".join(reversed(out)), place


class _Chat:
    """One conversation as its rows stream by."""

    def __init__(self, conv_id, program: Steps):
        self.conv_id, self.program = conv_id, program
        self.state, self.cost = Steps.first, 0
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.faults = [0, 0, 0, 0]
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.turns = 0
        self.steps = bytearray()
        self.spilled = 0

    @staticmethod
    def _line(place: int, into, role: str, text: str):
        into.update(((role if place == _START else "\n" + role) + ":" + text).encode())

    def _insert(self, place: int, into, n: int) -> int:
        for _ in range(n):
            x = _INSERTED[place]
            self._line(place, into, _ROLES[x], "")
            place = _NEXT[place][x]
        return place

    def add(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        self.state, rise, back, packed = self.program.step(
            self.state, initial if initial in ("s", "u", "a") else "-", fault in (1, 2), fault == 3)
        self.cost += rise
        self.steps += packed
        hashes: list = [None] * 4
        for to, way in enumerate(back):
            if way is None:
                continue
            place, n, edit = way
            got = self.hashes[place]
            if n or edit != "D":
                got = got.copy()
                at = self._insert(place, got, n)
                if edit == "K":
                    self._line(at, got, role, text)
                elif edit == "R":
                    self._line(at, got, "assistant" if to == _AFTER_A else "user", text)
            hashes[to] = got
        self.hashes = hashes

    def spill(self) -> tuple | None:
        """A row of full blocks of backpointers, if there are any."""
        if len(self.steps) < 4 * SPILL_ROWS:
            return None
        row = (self.conv_id, self.spilled, *[None] * 9, bytes(self.steps))
        self.steps, self.spilled = bytearray(), self.spilled + 1
        return row

    def result(self) -> tuple:
        """The conversation's row. Of one that spilled, the audit holds the end
        only, and ``place`` says where it begins."""
        more, place, n = self.program.end(self.state)
        end = self.hashes[place].copy()
        self._insert(place, end, n)
        audit, begin = _trace(np.frombuffer(bytes(self.steps), np.uint8).reshape(-1, 4), place)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, self.spilled, gaps, *self.faults[1:], self.illegal, self.cost + more,
                audit + "I" * n, end.hexdigest(), begin if self.spilled else None, None)


_COLUMNS = [x.split()[0] for x in _SCHEMA.split(",")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
    for c in _COLUMNS[:8] + ["place"]:
        out[c] = out[c].astype("Int64")
    return out


def _whole(x) -> int | None:
    return None if pd.isna(x) else int(x)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    program, chat = Steps(), None
    for batch in batches:
        out = []
        for conv_id, turn, role, text, gone, fault in batch.itertuples(index=False, name=None):
            conv_id = _whole(conv_id)
            if chat is None or conv_id != chat.conv_id:
                if chat is not None:
                    out.append(chat.result())
                chat = _Chat(conv_id, program)
            if not gone:
                chat.add(_whole(turn), role, text, fault)
                if (row := chat.spill()) is not None:
                    out.append(row)
        if out:
            yield _frame(out)
    if chat is not None:
        yield _frame([chat.result()])


def _trace_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of spilled conversations, last one first -> their audit pieces."""
    place = None
    for batch in batches:
        out = []
        for conv_id, block, begin, audit, steps in batch.itertuples(index=False, name=None):
            if steps is None:
                place = int(begin)
            else:
                audit, place = _trace(np.frombuffer(steps, np.uint8).reshape(-1, 4), place)
            out.append((_whole(conv_id), int(block), audit))
        made = pd.DataFrame(out, columns=["conv_id", "block", "audit"], dtype=object)
        made["conv_id"], made["block"] = made["conv_id"].astype("Int64"), made["block"].astype("Int64")
        yield made


def repair_rows(rows: DataFrame) -> DataFrame:
    """Per conversation of rows (conv_id, turn, role, text, gone): ``gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    ready(rows.sparkSession)
    return _audits(written(_sorted_rows(rows).mapInPandas(_walk, _SCHEMA), "chat-repair"))


def _audits(first: DataFrame) -> DataFrame:
    """The conversations of the first pass; those that spilled are traced back."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    done = first.where("steps IS NULL")
    spilled = first.where("steps IS NOT NULL OR place IS NOT NULL").select("conv_id", "block", "place", "audit", "steps")
    if spilled.isEmpty():
        return done.select("conv_id", *counts, "audit", "repaired_sha256")
    pieces = (spilled.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc())
              .withColumn("conv_id", F.col("conv_id").cast("string"))
              .mapInPandas(_trace_back, "conv_id long, block long, audit string"))
    whole = pieces.groupBy("conv_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda p: p["audit"]), "").alias("pieced"))
    joined = done.join(whole, done.conv_id.eqNullSafe(whole.conv_id), "left").drop(whole.conv_id)
    return joined.select("conv_id", *counts, F.coalesce("pieced", "audit").alias("audit"), "repaired_sha256")


def repair_chats(chats: DataFrame) -> DataFrame:
    """``repair_rows`` of the conversations (conv_id, turn, role, text) as they are."""
    space = F.lit(" ")
    return repair_rows(chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(False).alias("gone")))
