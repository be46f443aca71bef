"""Record framing (F1-F8): Kafka messages -> whole JSON object texts.

Batch plan. Framing is sequential per (topic, partition) in offset order,
but a Kafka partition may hold a third of all messages, so it is never one
task per partition:

1. F1/F2: decode, Java-trim, drop null and blank values (column exprs).
2. Per message, JVM side: whether it is *self-contained* (balanced groups
   of depth <= ``fast_depth`` and nothing else: one possessive regex), else
   ``a`` = net depth change and ``m`` = lowest prefix (<= 0) of its brace walk.
3. Narrow pass: only messages that change the depth matter (self-contained
   ones have ``a = m = 0``). Per offset block their sorted ``(offset, a, m)``
   is gathered (map-side partial aggregation), each block is summarised as
   the clamped walk ``f(d) = max(d + A, A - M)``, a window over the few block
   summaries gives the depth entering each block, and a second walk finds
   the first offset of the block where no record is open. Block edges moved
   there give *segments* that no record crosses. The block table is
   checkpointed, so its size is known: up to ``MAX_BROADCAST_BLOCKS`` rows it is
   broadcast.
4. Wide pass: the second and last read of the payload; messages are shuffled
   once, by (topic, partition, segment). Every segment starts at depth 0, so
   the depth entering each message
   (``d_in = P - least(0, min_{i<k}(P_i + m_i))``, P = prefix sum of ``a``),
   the key of the open record and the cutting are window / row work inside
   that partitioning: self-contained messages entered at depth 0 are cut by
   ``regexp_extract_all``; the rest are scanned once over their brace tokens
   for the piece that closes a carried record and the one left open, and what
   lies between is cut by regex too, so the work is linear in the message
   (objects over ``SCAN_DEPTH`` deep excepted). No Python anywhere.
5. Pieces of a record meet in one group per record (still no shuffle).
   Records have no length limit. Only a record that never closes in this input
   is not gathered: its pieces stay rows, and whole blocks inside it are
   segments of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window, functions as F

from tripstream.config import ensure_checkpoint_dir
from tripstream.functions.text import decode_utf8, java_trim
from tripstream.operators import quoted

WHOLE = "whole"     # record opens and closes in this message
HEAD = "head"       # closes a record opened in an earlier message
MIDDLE = "middle"   # the whole message lies inside an open record
TAIL = "tail"       # opens a record that goes on after this message

DEFAULT_BLOCK = None             # offsets per scan block; None: from the offset spans
MIN_BLOCK = 1 << 10
MAX_BLOCK = 1 << 17              # bounds what a task holds of a block (step list, texts), whatever the data size
MAX_BLOCKS = 200_000             # keeps the per-block table small
MAX_BROADCAST_BLOCKS = 500_000   # rows of about 60 bytes
DEFAULT_FAST_DEPTH = 8           # deepest object the regex path frames
SCAN_DEPTH = 40                  # deepest object that a scanned message's records are cut by regex
MAX_RECORD_CHARS = 1 << 26       # longest record that is put together (a row ends at 2 GB)

KEYS = ["topic", "partition"]

RECORD_SCHEMA = "topic string, partition int, offset long, pos int, record string"


def object_pattern(depth: int) -> str:
    """Possessive regex for one balanced ``{...}`` group of depth <= ``depth``.

    Braces are written as classes (``[{]``) so the text can sit in SQL as is.
    """
    p = "[{][^{}]*+[}]"
    for _ in range(depth - 1):
        p = "[{][^{}]*+(?:" + p + "[^{}]*+)*+[}]"
    return p


def self_contained_pattern(depth: int) -> str:
    return "^[^{}]*+(?:" + object_pattern(depth) + "[^{}]*+)*+$"


def placed(messages: DataFrame) -> DataFrame:
    """Messages with a topic, a partition and an offset (others cannot be framed)."""
    return messages.where(F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull())


def decode_messages(messages: DataFrame) -> DataFrame:
    """F1 + F2: ``topic, partition, offset, text, pos0`` for non-null, non-blank values.

    ``pos0`` (0 unless the messages have that column) is the number of records
    that opened in the message before this text, for a text carried over
    from an earlier batch.
    """
    pos0 = F.col("pos0") if "pos0" in messages.columns else F.lit(0)
    return (
        placed(messages).where(F.col("value").isNotNull())
        .select(*KEYS, "offset", java_trim(decode_utf8("value")).alias("text"), pos0.alias("pos0"))
        .where(F.col("text") != "")
    )


def unplaced_messages(messages: DataFrame) -> DataFrame:
    """Messages without topic, partition or offset, as rejects."""
    return (messages.where(F.col("topic").isNull() | F.col("partition").isNull() | F.col("offset").isNull())
            .select(F.lit("unplaced").alias("reason"), decode_utf8("value").alias("record"), *KEYS, "offset"))


# struct(a, m) of a message's brace walk: net change, lowest prefix (<= 0)
_PROFILE_SQL = """aggregate(regexp_extract_all(text, '[{}]', 0), named_struct('a', 0, 'm', 0),
  (acc, b) -> named_struct('a', acc.a + if(b = '{', 1, -1),
                           'm', least(acc.m, acc.a + if(b = '{', 1, -1))))"""

# One pass over the brace / non-brace tokens of a message entered at depth d_in,
# with plain numbers only (linear): chars consumed, depth, end of the piece that
# closes a carried record (-1: none), start of the record left open (-1: none),
# deepest level of the records in between.
_SCAN_SQL = """aggregate(regexp_extract_all(text, '[{}]|[^{}]+', 0),
  named_struct('pos', 0, 'd', CAST(d_in AS INT), 'head', -1, 'start', -1, 'top', 0),
  (st, x) -> named_struct(
    'pos', st.pos + length(x),
    'd', CASE WHEN x = '{' THEN st.d + 1 WHEN x = '}' AND st.d > 0 THEN st.d - 1 ELSE st.d END,
    'head', CASE WHEN x = '}' AND st.d = 1 AND st.start = -1 AND st.head = -1 THEN st.pos + 1 ELSE st.head END,
    'start', CASE WHEN x = '{' AND st.d = 0 THEN st.pos WHEN x = '}' AND st.d = 1 THEN -1 ELSE st.start END,
    'top', CASE WHEN x = '{' AND (st.start >= 0 OR st.d = 0) THEN greatest(st.top, st.d + 1) ELSE st.top END))"""

# what lies between the two: whole records and text outside of records
_BETWEEN_SQL = """CASE WHEN d_in > 0 AND _st.head < 0 THEN ''
  ELSE substring(text, greatest(_st.head, 0) + 1,
                 if(_st.start >= 0, _st.start, length(text)) - greatest(_st.head, 0)) END"""

# Records deeper than the regex: a walk that appends them one by one.
_DEEP_SQL = """aggregate(regexp_extract_all(between, '[{}]|[^{}]+', 0),
  named_struct('pos', 0, 'd', 0, 'start', -1, 'recs', CAST(array() AS array<string>)),
  (st, x) -> named_struct(
    'pos', st.pos + length(x),
    'd', CASE WHEN x = '{' THEN st.d + 1 WHEN x = '}' AND st.d > 0 THEN st.d - 1 ELSE st.d END,
    'start', CASE WHEN x = '{' AND st.d = 0 THEN st.pos ELSE st.start END,
    'recs', CASE WHEN x = '}' AND st.d = 1
                 THEN array_append(st.recs, substring(between, st.start + 1, st.pos + 1 - st.start))
                 ELSE st.recs END)).recs"""


def _cut_sql() -> str:
    """Pieces of a scanned message; pos: how many records opened in the message before."""
    return f"""filter(concat(
    array(CASE WHEN d_in > 0 AND _st.head >= 0
               THEN named_struct('pos', -1, 'piece', substring(text, 1, _st.head), 'kind', '{HEAD}')
               WHEN d_in > 0 THEN named_struct('pos', -1, 'piece', text, 'kind', '{MIDDLE}') END),
    transform(recs, (r, i) -> named_struct('pos', pos0 + i, 'piece', r, 'kind', '{WHOLE}')),
    array(CASE WHEN _st.d > 0 AND _st.start >= 0
               THEN named_struct('pos', pos0 + size(recs), 'piece', substring(text, _st.start + 1), 'kind', '{TAIL}')
               END)),
  p -> p IS NOT NULL)"""


# block summary over its sorted steps L: total change A, lowest point M
_BLOCK_SQL = """aggregate(L, named_struct('P', CAST(0 AS BIGINT), 'M', CAST(0 AS BIGINT)),
  (acc, x) -> named_struct('P', acc.P + x.a, 'M', least(acc.M, acc.P + x.m)))"""

# Of a block entered at depth D: z, the first offset from which no record is open;
# key, the last message that leaves a record open which it opened.
_WALK_SQL = """aggregate(L, named_struct('d', D, 'z', CASE WHEN D = 0 THEN block * {B} END, 'key', CAST(NULL AS BIGINT)),
  (acc, x) -> named_struct(
    'd', greatest(acc.d + x.a, x.a - x.m),
    'z', coalesce(acc.z, CASE WHEN greatest(acc.d + x.a, x.a - x.m) = 0 THEN x.offset + 1 END),
    'key', CASE WHEN acc.d + x.m <= 0 AND greatest(acc.d + x.a, x.a - x.m) > 0 THEN x.offset ELSE acc.key END))"""


def choose_block_size(messages: DataFrame, target_blocks: int | None = None) -> int:
    """Offsets per block, from the offset span of each (topic, partition).

    One aggregation that reads no payload (a Kafka source knows these ranges
    up front); result has one row per Kafka partition. Aims at
    ``target_blocks`` segments (default 4 x default parallelism), a power of
    two between ``MIN_BLOCK`` and ``MAX_BLOCK``, and no more than
    ``MAX_BLOCKS`` blocks while that bound allows (up to about 2e11
    offsets; beyond it the block table grows, but no block's list does).
    """
    spans = (placed(messages).groupBy(*KEYS).agg((F.max("offset") - F.min("offset") + 1).alias("n"))
             .agg(F.sum("n")).first())
    total = int(spans[0] or 0)
    if target_blocks is None:
        target_blocks = 4 * messages.sparkSession.sparkContext.defaultParallelism
    want = max(1, -(-total // max(target_blocks, 1)), -(-total // MAX_BLOCKS))
    size = MIN_BLOCK
    while size < min(want, MAX_BLOCK):
        size <<= 1
    return size


def _blocks(prof: DataFrame, block_size: int) -> DataFrame:
    """``block, state, touch, seg_start, opener`` per (topic, partition, block) of
    profiled messages: the depth entering the block, whether no record is open
    at some point of it (maybe inside a message), the first offset from which none
    is, and the message that opened the record open at its end (if it is in it)."""
    blk = F.floor(F.col("offset") / F.lit(block_size)).cast("long")
    step = F.when(~F.col("fast"), F.struct("offset", "a", "m"))
    blocks = (prof.select(*KEYS, blk.alias("block"), step.alias("st"))
              .where(F.col("block").isNotNull())
              .groupBy(*KEYS, "block").agg(F.array_sort(F.collect_list("st")).alias("L")))
    blocks = blocks.select(*KEYS, "block", "L", F.expr(_BLOCK_SQL).alias("s"))
    wb = Window.partitionBy(*KEYS).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    pa = F.coalesce(F.sum("s.P").over(wb), F.lit(0)).cast("long")
    t = blocks.select(*KEYS, "block", "L", "s", pa.alias("PA"))
    x = F.min(F.col("PA") + F.col("s.M")).over(wb)
    t = t.select(*KEYS, "block", "L", "s",
                 (F.col("PA") - F.least(F.lit(0), F.coalesce(x, F.lit(0)))).alias("D"))
    t = t.select(*KEYS, "block", "D", (F.col("D") + F.col("s.M") <= 0).alias("touch"),
                 F.expr(_WALK_SQL.format(B=block_size)).alias("w"))
    return t.select(*KEYS, "block", F.col("D").alias("state"), "touch",
                    F.col("w.z").alias("seg_start"), F.col("w.key").alias("opener"))


def _cut_points(blocks: DataFrame) -> DataFrame:
    """How the offsets of each (topic, partition, block) map to segments.

    Every block starts a segment. A *natural* one starts at ``seg_start``, the
    first offset of the block where no record is open; the offsets before belong
    to the block before. Where a record stays open throughout a block, the
    segment is *forced*: it starts with the block, in the ``state`` entering it
    and inside the record that the message ``key`` opened. So a segment holds two
    blocks at most, however long a record is. ``later``: no record is open at some
    point of a later block, so one left open here closes.
    """
    w = Window.partitionBy(*KEYS).orderBy("block")
    t = blocks.select(
        "*", F.col("seg_start").isNull().alias("forced"),
        F.last("opener", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("key"),
        F.coalesce(F.max("touch").over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(False)).alias("later"))
    before = [F.lag(c).over(w).alias(f"prev_{c}") for c in ("block", "forced", "state", "key", "later")]
    return t.select(*KEYS, "block", "touch", "seg_start", "forced", "state", "key", "later", *before)


def _segments(prof: DataFrame, block_size: int) -> DataFrame:
    return _cut_points(_blocks(prof, block_size))


def _placed_in_segments(rows: DataFrame, segs: DataFrame, block_size: int, few) -> DataFrame:
    """``rows`` (with offset) plus ``seg``, and the segment's entering state ``d0``,
    its open record's key ``k0`` and ``later``."""
    blk = F.floor(F.col("offset") / F.lit(block_size)).cast("long")
    own = F.col("forced") | (F.col("offset") >= F.col("seg_start"))
    cols = rows.columns
    return rows.withColumn("block", blk).join(few(segs), [*KEYS, "block"]).select(
        *cols, F.when(own, F.col("block")).otherwise(F.col("prev_block")).alias("seg"),
        F.when(own & F.col("forced"), F.col("state")).when(~own & F.col("prev_forced"), F.col("prev_state"))
        .otherwise(F.lit(0)).cast("long").alias("d0"),
        F.when(own & F.col("forced"), F.col("key")).when(~own & F.col("prev_forced"), F.col("prev_key")).alias("k0"),
        F.when(own, F.col("later")).otherwise(F.col("prev_later")).alias("later"))


def _profiled(dec: DataFrame, fast_depth: int, regex_fast_path: bool) -> DataFrame:
    fast = F.col("text").rlike(self_contained_pattern(fast_depth)) if regex_fast_path else F.lit(False)
    prof = dec.select(*KEYS, "offset", "text", "pos0", fast.alias("fast")).select(
        "*", F.when(F.col("fast"), F.struct(F.lit(0).alias("a"), F.lit(0).alias("m")))
        .otherwise(F.expr(_PROFILE_SQL)).alias("pr"))
    return prof.select(*KEYS, "offset", "text", "pos0", "fast", "pr.a", "pr.m")


def _brace_walk(dec: DataFrame, again: DataFrame, block_size: int, fast_depth: int,
                regex_fast_path: bool) -> tuple[DataFrame, DataFrame, int]:
    """Messages in their segments with the depth entering each (``d_in``), and
    whether it has no record of another's (``fast``); the block table, its rows.
    ``dec`` is read for the block table, ``again`` (the same messages) for the texts."""
    segs = _segments(_profiled(dec, fast_depth, regex_fast_path), block_size).checkpoint()
    n_blocks = segs.count()
    wide = _placed_in_segments(_profiled(again, fast_depth, regex_fast_path), segs, block_size, _few(n_blocks))
    wide = _to_segments(wide, n_blocks)

    # depth entering each message (segments start at d0)
    before = Window.partitionBy(*KEYS, "seg").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    wide = wide.select("*", F.coalesce(F.sum("a").over(before), F.lit(0)).alias("P"))
    lmin = F.coalesce(F.min(F.col("P") + F.col("m")).over(before), F.lit(0))
    # clamped walk from the segment's entering depth d0: max(d0 + A, A - M)
    d_in = F.greatest(F.col("d0") + F.col("P"), F.col("P") - F.least(F.lit(0), lmin))
    return wide.select(*KEYS, "seg", "offset", "text", "pos0", "fast", "k0", "later", d_in.alias("d_in")), segs, n_blocks


def _string_walk(dec: DataFrame, again: DataFrame, block_size: int, fast_depth: int,
                 regex_fast_path: bool) -> tuple[DataFrame, DataFrame, int]:
    """The same with strings passed over; ``d_in`` is a state of ``quoted``.

    The states come from walks over the blocks' codes; they go to the segments
    beside the texts (no text in them) and meet their message there.
    """
    blocks, states = quoted.locate(dec, block_size, lambda t, n: _few(n)(t))
    segs = _cut_points(blocks).checkpoint()
    n_blocks = segs.count()
    few = _few(n_blocks)
    fast = F.col("text").rlike(quoted.self_contained_pattern(fast_depth)) if regex_fast_path else F.lit(False)
    texts = again.select(*KEYS, "offset", "text", "pos0", F.lit(None).cast(states.schema["met"].dataType).alias("met"))
    states = states.select(*KEYS, "offset", F.lit(None).cast("string").alias("text"), F.lit(0).alias("pos0"), "met")
    wide = _to_segments(_placed_in_segments(texts.unionByName(states), segs, block_size, few), n_blocks)
    here = Window.partitionBy(*KEYS, "seg", "offset")
    wide = wide.withColumn("met", F.max("met").over(here)).where(F.col("text").isNotNull())
    return (wide.select(*KEYS, "seg", "offset", "text", "pos0", fast.alias("fast"), "k0", "later", "met",
                        F.col("met.s_in").alias("d_in")), segs, n_blocks)


def _few(rows: int):
    return F.broadcast if rows <= MAX_BROADCAST_BLOCKS else lambda df: df


def _to_segments(wide: DataFrame, n_blocks: int) -> DataFrame:
    """One task per segment or a few: an explicit count, so the post-shuffle work
    (cutting, parsing) is not coalesced into a handful of tasks just because the
    shuffled bytes are few. A segment holds about one block."""
    tasks = max(wide.sparkSession.sparkContext.defaultParallelism, min(n_blocks, MAX_BLOCKS))
    return wide.repartition(tasks, *KEYS, "seg")


def _pieces(wide: DataFrame, string_aware: bool, fast_depth: int) -> DataFrame:
    """The pieces of records that each message holds: ``offset, pos, piece, kind``,
    the message that opens the record (``rec_offset``), ``gpos`` that tells whole ones
    of a message apart, and the segment's ``later``."""
    pattern, scan, deep = ((quoted.object_pattern, quoted.SCAN_SQL, quoted.DEEP_SQL) if string_aware
                           else (object_pattern, _SCAN_SQL, _DEEP_SQL))
    wide = wide.select("*", (F.col("fast") & (F.col("d_in") == 0)).alias("quick"))
    # staged through generators, so that each step is computed once per message
    wide = wide.select("*", F.explode(F.array(F.when(~F.col("quick"), F.expr(scan)))).alias("_st"))
    before = Window.partitionBy(*KEYS, "seg").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.when((F.col("_st.d") > 0) & (F.col("_st.start") >= 0), F.col("offset"))
    wide = wide.select("*", F.coalesce(F.max(opens).over(before), F.col("k0")).alias("open_key"))
    wide = wide.select("*", F.explode(F.array(F.when(~F.col("quick"), F.expr(_BETWEEN_SQL)))).alias("between"))
    recs = (F.when(F.col("_st.top") <= SCAN_DEPTH,
                   F.regexp_extract_all(F.col("between"), F.lit(pattern(SCAN_DEPTH)), F.lit(0)))
            .when(F.col("_st").isNotNull(), F.expr(deep)))
    wide = wide.select("*", F.explode(F.array(recs)).alias("recs"))

    # cut: regex for self-contained messages entered outside, the scan's parts otherwise
    whole = F.regexp_extract_all(F.col("text"), F.lit(pattern(max(fast_depth, 1))), F.lit(0))
    cut = F.when(F.col("quick"), F.transform(whole, lambda x, i: F.struct(
        (F.col("pos0") + i).alias("pos"), x.alias("piece"), F.lit(WHOLE).alias("kind")))).otherwise(F.expr(_cut_sql()))
    pieces = wide.select(*KEYS, "seg", "offset", "open_key", "later", F.explode(cut).alias("p"))
    kind = F.col("p.kind")
    return pieces.select(
        *KEYS, "seg", "offset", "later", F.col("p.pos").alias("pos"), F.col("p.piece").alias("piece"), kind.alias("kind"),
        F.when(kind.isin(WHOLE, TAIL), F.col("offset")).otherwise(F.col("open_key")).alias("rec_offset"),
        F.when(kind == WHOLE, F.col("p.pos")).otherwise(F.lit(-1)).alias("gpos"))


def frame_records(messages: DataFrame, block_size: int | None = DEFAULT_BLOCK,
                  fast_depth: int = DEFAULT_FAST_DEPTH, regex_fast_path: bool = True,
                  emit_open: bool = False, string_aware: bool = False,
                  max_record_chars: int = MAX_RECORD_CHARS, emit_long: bool = False,
                  seen: Observation | None = None) -> DataFrame:
    """Frame messages into records: ``topic, partition, offset, pos, record``.

    ``offset`` / ``pos`` locate a record: the message in which it opens, and how
    many records opened there before it. ``emit_open=True`` adds ``open`` and also
    returns the pieces of the record still open at the end of each (topic,
    partition), one row per message, at that message's offset; a micro-batch
    stream carries them into the next batch, a batch job rejects them.
    ``emit_long=True`` adds ``piece_offset`` and also returns the records of more
    than ``max_record_chars`` characters, as their pieces: one row per message,
    ``offset`` the record's, ``piece_offset`` the message's (null for other rows); in that
    order they are the record, and they are never gathered. ``string_aware=True``
    does not count braces inside JSON strings. ``regex_fast_path=False`` sends every
    message through the token scan. ``seen`` observes ``messages_in`` (F8): non-null values
    of messages that are not ``carried`` over, in the pass that moves the texts.
    """
    spark = messages.sparkSession
    dec = decode_messages(messages)
    counted = dec
    if seen is not None:
        new = ~F.col("carried") if "carried" in messages.columns else F.lit(True)
        counted = decode_messages(messages.observe(seen, F.count_if(F.col("value").isNotNull() & new).alias("messages_in")))
    if block_size is None:
        block_size = min(choose_block_size(messages), quoted.MAX_BLOCK if string_aware else MAX_BLOCK)
    ensure_checkpoint_dir(spark)
    walk = _string_walk if string_aware else _brace_walk
    wide, segs, n_blocks = walk(dec, counted, block_size, fast_depth, regex_fast_path)
    pieces = _pieces(wide, string_aware, fast_depth)

    # A record's pieces in one segment meet without a shuffle. Whether it closes and
    # how long it is are known first (window, no gathering).
    wg = Window.partitionBy(*KEYS, "seg", "rec_offset", "gpos")
    opened = F.max(F.col("kind").isin(WHOLE, TAIL)).over(wg)
    closes = F.max(kind_closes()).over(wg)
    pieces = pieces.select("*", (opened & closes).alias("here"), (closes | F.col("later")).alias("closed"),
                           F.sum(F.length("piece")).over(wg).alias("chars"))
    if not emit_open:
        pieces = pieces.where("closed")
    # only a forced segment is entered inside a record: without one in which, or after which,
    # a record closes, each closed record lies within one segment
    crossing = not segs.where("forced AND (touch OR later)").isEmpty()
    mine = pieces.where("here OR NOT closed") if crossing else pieces
    gather = F.col("here") & (F.col("chars") <= max_record_chars)
    out = _gathered(mine.select("*", gather.alias("whole")), ["seg"])
    if crossing:
        out = out.unionByName(_across_segments(pieces.where("closed AND NOT here"), max_record_chars, n_blocks))
    # ``part``: null of a whole record, else the message that a piece comes from
    long = F.col("part").isNotNull() & F.col("closed")
    if not emit_long:
        out = out.where(~long)
    cols = [*KEYS, F.when(F.col("part").isNull() | F.col("closed"), F.col("rec_offset")).otherwise(F.col("part")).alias("offset"),
            F.coalesce("pos", F.lit(0)).cast("int").alias("pos"), "record"]
    if emit_open:
        cols.append((~F.col("closed")).alias("open"))
    if emit_long:
        cols.append(F.when(long, F.col("part")).alias("piece_offset"))
    return out.select(*cols)


def _gathered(pieces: DataFrame, within: list[str]) -> DataFrame:
    """``rec_offset, closed, part, pos, record``: the pieces of a record put
    together where ``whole``, else (``part`` not null) one row each. No shuffle if
    ``within`` is what the pieces are dealt by."""
    whole = F.col("whole")
    recs = pieces.groupBy(
        *KEYS, *within, "closed", "rec_offset", "gpos", F.when(~whole, F.col("offset")).alias("part"),
        F.when(~whole, F.col("pos")).alias("gp")).agg(
        F.max(F.when(F.col("kind").isin(WHOLE, TAIL), F.col("pos"))).alias("pos"),
        F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("parts"))
    record = F.array_join(F.transform("parts", lambda p: p["piece"]), "")
    return recs.select(*KEYS, "rec_offset", "closed", "part", "pos", record.alias("record"))


def _across_segments(pieces: DataFrame, max_chars: int, n_blocks: int) -> DataFrame:
    """Records whose pieces lie in several segments, put together level by level:
    within each segment first, then by record. Those above the bound stay rows.

    Each such record holds a whole block at least, so there are no more of them
    than blocks: the table of their lengths is small.
    """
    key = [*KEYS, "rec_offset"]
    total = pieces.groupBy(*key).agg(F.sum(F.length("piece")).alias("total"))
    rows = pieces.join(_few(n_blocks)(total), key).withColumn("whole", F.col("total") <= max_chars)
    joined = (rows.where("whole").groupBy(*key, "seg").agg(
        F.min("offset").alias("first"), F.max(F.when(F.col("kind") == TAIL, F.col("pos"))).alias("pos"),
        F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("parts"))
        .select(*key, "first", "pos", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("piece")))
    recs = joined.groupBy(*key).agg(F.max("pos").alias("pos"),
                                    F.array_sort(F.collect_list(F.struct("first", "piece"))).alias("parts"))
    cols = [*KEYS, "rec_offset", F.lit(True).alias("closed")]
    recs = recs.select(*cols, F.lit(None).cast("long").alias("part"), "pos",
                       F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("record"))
    long = rows.where("NOT whole").select(*cols, F.col("offset").alias("part"),
                                          F.when(F.col("kind") == TAIL, F.col("pos")).alias("pos"),
                                          F.col("piece").alias("record"))
    return recs.unionByName(long)


def kind_closes():
    return F.col("kind").isin(WHOLE, HEAD)


def framing_counters(messages: DataFrame, records: DataFrame) -> DataFrame:
    """F8: messages in (non-null values, blank ones included) and objects out."""
    m = messages.select(F.when(F.col("value").isNotNull(), 1).otherwise(0).alias("mi"),
                        F.lit(0).alias("oo"))
    r = records.select(F.lit(0).alias("mi"), F.lit(1).alias("oo"))
    return m.unionByName(r).agg(F.sum("mi").cast("long").alias("messages_in"),
                                F.sum("oo").cast("long").alias("objects_out"))
