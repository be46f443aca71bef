"""String-aware framing: braces inside JSON strings do not count.

The state between two characters is the depth together with a mode: plain,
inside a string, or after a backslash inside a string. Outside of records only
``{`` matters, so a stray quote in junk does no harm. A state is one number,
``3 * depth + mode``, 0 outside of records.

What a message does depends on its *codes* only: its braces and quotes, with a
backslash before those that are escaped. What a block of messages does is a
*function* of the state it is entered in, which is not known when it is read:

* ``z``: the state after it when entered outside of a record;
* for each mode, for entering inside one: a thread ``[depth, mode, lo, exits]``, the
  change of depth and the mode after it when entered far inside; how far below the
  entering depth it comes; and for the entering depths from which it leaves the
  record (at most ``-lo``) the state after it, as runs ``[k, state]`` up to depth ``k``.

The entering states of the few blocks follow from one walk over the blocks of a
(topic, partition), and those of a block's messages from a walk over the block's
codes. No text is moved for it, and no walk is longer than a block or a
partition's list of blocks. Few code strings differ where messages are alike, so
what one does is remembered.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripstream.config import ship_package

KEYS = ["topic", "partition"]

MAX_BLOCK = 1 << 16              # bounds the codes that a walk holds
_KEPT = 1 << 14                  # code strings of at most _SHORT whose work is remembered
_SHORT = 256

# Without what changes no state: text, and escapes of other characters. A backslash
# that is left stands before a brace or a quote, or ends the text.
_CODES_SQL = r"""regexp_replace({text}, r'(?s)\\[^{{}}"]|[^{{}}"\\]++', '')"""
# The same for entering after a backslash, where the first character is passed over; null: no other.
_ESCAPED_SQL = (r"""CASE WHEN text RLIKE r'^[{}"\\]' THEN """ + _CODES_SQL.format(text="substring(text, 2)") + " END")


def _next(s: int, c: str, escaped: bool) -> int:
    """State after a brace or a quote. Outside of strings a backslash means nothing."""
    if s == 0:
        return 3 if c == "{" else 0
    if s % 3 == 0:
        return s + (3 if c == "{" else -3 if c == "}" else 1)
    return s - 1 if c == '"' and not escaped else s


def _steps(codes: str):
    """``character, escaped`` of the codes; a backslash that ends the text comes as itself."""
    escaped = False
    for c in codes:
        if c == "\\":
            escaped = True
        else:
            yield c, escaped
            escaped = False
    if escaped:
        yield "\\", False


def _run(codes: str, s: int) -> tuple[int, bool, int]:
    """The state after the codes when entered in ``s``, whether no record is open at some
    point, and the deepest level."""
    touched, top = s == 0, s
    for c, escaped in _steps(codes):
        if c == "\\":
            s += s % 3                   # inside a string
        else:
            s = _next(s, c, escaped)
            touched |= s == 0
            top = max(top, s)
    return s, touched, top // 3


def _thread(codes: str, mode: int) -> tuple:
    """The thread of a message entered in ``mode`` far inside a record."""
    depth, lo, exits = 0, 0, []
    for c, escaped in _steps(codes):
        if c == "\\":
            mode += mode
            for y in exits:
                y[1] += y[1] % 3
            continue
        for y in exits:
            y[1] = _next(y[1], c, escaped)
        if mode == 1:
            mode = 0 if c == '"' and not escaped else 1
        elif c == '"':
            mode = 1
        else:
            depth += 1 if c == "{" else -1
            if depth < lo:
                lo = depth
                if exits and exits[-1][1] == 0:
                    exits[-1][0] = -lo
                else:
                    exits.append([-lo, 0])
    return depth, mode, lo, tuple((k, s) for k, s in exits)


_run_kept, _thread_kept = lru_cache(_KEPT)(_run), lru_cache(_KEPT)(_thread)


def _codes_in(codes: str, escaped: str | None, mode: int) -> tuple[str, int]:
    """The codes and mode that a message is walked with when entered in ``mode``."""
    return (codes, mode) if mode < 2 else (codes if escaped is None else escaped, 1)


def _state_after(codes: str, escaped: str | None, s: int) -> tuple[int, bool, int]:
    if s % 3 == 2:
        codes, s = (codes if escaped is None else escaped), s - 1
    return (_run_kept if len(codes) <= _SHORT else _run)(codes, s)


def block_function(messages) -> tuple[int, list]:
    """``z`` and the threads of the messages (codes, escaped) of a block."""
    z, threads = 0, [[0, mode, 0, []] for mode in range(3)]
    for codes, escaped in messages:
        z = _state_after(codes, escaped, z)[0]
        for t in threads:
            mine, mode = _codes_in(codes, escaped, t[1])
            depth, mode, lo, exits = (_thread_kept if len(mine) <= _SHORT else _thread)(mine, mode)
            if t[3]:
                t[3] = [[k, _state_after(codes, escaped, s)[0]] for k, s in t[3]]
            if t[0] + lo < t[2]:
                t[3] += [[k - t[0], s] for k, s in exits if k - t[0] > -t[2]]
                t[2] = t[0] + lo
            if len(t[3]) > 1:
                t[3] = [y for y, after in zip(t[3], [*t[3][1:], None]) if after is None or y[1] != after[1]]
            t[0], t[1] = t[0] + depth, mode
    return z, threads


def applied(function, s: int) -> int:
    """The state after a block with this function when entered in ``s``."""
    z, threads = function
    depth, mode, lo, exits = threads[s % 3]
    if s == 0:
        return z
    if s // 3 + lo > 0:
        return 3 * (s // 3 + depth) + mode
    return next(after for k, after in exits if k >= s // 3)


def _functions(block: pa.Table) -> pa.Table:
    block = block.sort_by("offset")
    function = block_function(zip(block["codes"].to_pylist(), block["escaped"].to_pylist()))
    return block.slice(0, 1).select([*KEYS, "block"]).append_column("fn", pa.array([json.dumps(function)]))


def _entered(blocks: pa.Table) -> pa.Table:
    blocks, s, states = blocks.sort_by("block"), 0, []
    for function in blocks["fn"]:
        states.append(s)
        s = applied(json.loads(function.as_py()), s)
    return blocks.select([*KEYS, "block"]).append_column("state", pa.array(states, pa.int64()))


def _met(block: pa.Table) -> pa.Table:
    block = block.sort_by("offset")
    s, before, after, touched, top = block["state"][0].as_py(), [], [], [], []
    for codes, escaped in zip(block["codes"].to_pylist(), block["escaped"].to_pylist()):
        before.append(s)
        s, at, deepest = _state_after(codes, escaped, s)
        after.append(s)
        touched.append(at)
        top.append(deepest)
    block = block.select([*KEYS, "block", "offset"])
    for name, values, kind in (("s_in", before, pa.int64()), ("s_out", after, pa.int64()), ("touched", touched, pa.bool_()),
                               ("top", top, pa.int64())):
        block = block.append_column(name, pa.array(values, kind))
    return block


def locate(messages: DataFrame, block_size: int, few) -> tuple[DataFrame, DataFrame]:
    """Blocks and messages with the states they are entered in, of messages
    (topic, partition, offset, text).

    Blocks: ``topic, partition, block, state, touch, seg_start, opener``;
    messages: ``topic, partition, block, offset, met``, what is ``met`` being the states
    before and after it, whether it is touched, and its deepest level. ``few(df, n)`` is
    ``df`` with a broadcast hint if its ``n`` rows are few enough.
    """
    spark = messages.sparkSession
    ship_package(spark)
    by = [*KEYS, "block"]
    blk = F.floor(F.col("offset") / F.lit(block_size)).cast("long")
    # codes are few bytes: the blocks are dealt by an explicit count, not put together by size
    tasks = max(8 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (messages.select(*KEYS, blk.alias("block"), "offset", F.expr(_CODES_SQL.format(text="text")).alias("codes"),
                             F.expr(_ESCAPED_SQL).alias("escaped"))).checkpoint().repartition(tasks, *by)
    key = "topic string, partition int, block long"
    functions = found.groupBy(*by).applyInArrow(_functions, f"{key}, fn string").checkpoint()
    states = functions.groupBy(*KEYS).applyInArrow(_entered, f"{key}, state long")
    walked = (found.join(few(states, functions.count()), by).groupBy(*by)
              .applyInArrow(_met, f"{key}, offset long, s_in long, s_out long, touched boolean, top long")).checkpoint()
    blocks = walked.groupBy(*by).agg(
        F.min_by("s_in", "offset").alias("state"), F.max("touched").alias("touch"),
        F.min(F.when(F.col("s_out") == 0, F.col("offset"))).alias("closed"),
        F.max(F.when(F.col("touched") & (F.col("s_out") > 0), F.col("offset"))).alias("opener"))
    blocks = blocks.select(*by, "state", "touch", F.when(F.col("state") == 0, F.col("block") * block_size)
                           .otherwise(F.col("closed") + 1).alias("seg_start"), "opener")
    return blocks, walked.select(*by, "offset", F.struct("s_in", "s_out", "touched", "top").alias("met"))


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


_STRING = r'"(?:[^"\\]++|\\.)*+"'


def object_pattern(depth: int) -> str:
    """Possessive regex of one object of depth <= ``depth``, strings passed over."""
    p = "[{](?:[^{}\"]++|" + _STRING + ")*+[}]"
    for _ in range(depth - 1):
        p = "[{](?:[^{}\"]++|" + _STRING + "|" + p + ")*+[}]"
    return "(?s)" + p


def self_contained_pattern(depth: int) -> str:
    return "(?s)^[^{}\"]*+(?:" + object_pattern(depth)[4:] + "[^{}\"]*+)*+$"


def _scan_next(s: str) -> str:
    """State after token ``x`` (an escape, a quote, a brace, or text without any)."""
    return (f"(CASE WHEN {s} = 0 THEN if(right(x, 1) = '{{', 3L, 0L) "
            f"WHEN {s} % 3 = 0 THEN {s} + CASE right(x, 1) WHEN '{{' THEN 3L WHEN '}}' THEN -3L WHEN '\"' THEN 1L ELSE 0L END "
            f"ELSE {s} + CASE x WHEN '\"' THEN -1L WHEN r'\\' THEN 1L ELSE 0L END END)")


_TOKENS = r"""r'(?s)\\.|["{}]|[^"{}\\]+|\\'"""

# As the scan of the plain framing: chars consumed, state, end of the piece that closes
# a carried record, start of the record left open, deepest level of the records in between.
_WALK_SQL = (
    "aggregate(regexp_extract_all(if(d_in % 3 = 2, substring(text, 2), text), " + _TOKENS
    + ", 0), named_struct('pos', if(d_in % 3 = 2, 1, 0), 'd', if(d_in % 3 = 2, d_in - 1, d_in), 'head', -1, 'start', -1, 'top', 0L), "
    "(st, x) -> " + _let(_scan_next("st.d"), "n", """named_struct(
      'pos', st.pos + length(x), 'd', n,
      'head', CASE WHEN n = 0 AND st.d > 0 AND st.start = -1 AND st.head = -1 THEN st.pos + length(x) ELSE st.head END,
      'start', CASE WHEN st.d = 0 AND n > 0 THEN st.pos + length(x) - 1 WHEN n = 0 THEN -1 ELSE st.start END,
      'top', CASE WHEN st.start >= 0 OR st.d = 0 THEN greatest(st.top, n div 3) ELSE st.top END)""") + ")")

# Where no object is deeper than ``REGEX_DEPTH`` the states before and after the message
# say what there is to find, and possessive regexes find it: what is left of a carried
# record at most ``_CARRIED`` deep, and the whole records before the one left open.
REGEX_DEPTH = 8
_CARRIED = 4
_OBJECT = object_pattern(REGEX_DEPTH)[4:]
_LEVEL = "(?:[^{}\"]++|" + _STRING + "|" + _OBJECT + ")*+[}]"
_QUOTED_REST = r'(?:[^"\\]++|\\.)*+"'
_HEADS = {3 * depth + mode: "(?s)^" + mode * _QUOTED_REST + depth * _LEVEL
          for depth in range(1, _CARRIED + 1) for mode in (0, 1)}
_OUTSIDE = "(?s)^(?:[^{]*+" + _OBJECT + ")*+[^{]*+"
_HEAD_SQL = ("CASE WHEN d_in = 0 OR NOT met.touched THEN -1 "
             + " ".join(f"WHEN d_in = {k} THEN length(regexp_extract(text, r'{p}', 0))" for k, p in _HEADS.items()) + " END")
_START_SQL = (f"CASE WHEN met.touched AND met.s_out > 0 THEN greatest(h, 0) + "
              f"length(regexp_extract(substring(text, greatest(h, 0) + 1), r'{_OUTSIDE}', 0)) ELSE -1 END")
SCAN_SQL = (f"CASE WHEN met.top <= {REGEX_DEPTH} AND (NOT met.touched OR d_in = 0 OR d_in IN ({', '.join(map(str, _HEADS))})) THEN "
            + _let(_HEAD_SQL, "h", f"named_struct('pos', length(text), 'd', met.s_out, 'head', h, 'start', {_START_SQL}, "
                                   "'top', 0L)") + f" ELSE {_WALK_SQL} END")

DEEP_SQL = (
    "aggregate(regexp_extract_all(between, " + _TOKENS
    + ", 0), named_struct('pos', 0, 'd', 0L, 'start', -1, 'recs', CAST(array() AS array<string>)), "
    "(st, x) -> " + _let(_scan_next("st.d"), "n", """named_struct(
      'pos', st.pos + length(x), 'd', n,
      'start', CASE WHEN st.d = 0 AND n > 0 THEN st.pos + length(x) - 1 ELSE st.start END,
      'recs', CASE WHEN n = 0 AND st.d > 0
                   THEN array_append(st.recs, substring(between, st.start + 1, st.pos + length(x) - st.start))
                   ELSE st.recs END)""") + ").recs")
