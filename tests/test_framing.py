"""Framing: batch plan and stream state against an independent model."""

import random

from pyspark.sql import functions as F

from tripstream.operators.framing import decode_messages, frame_records, framing_counters
from tripstream.schema import MESSAGE_SCHEMA


def model(messages):
    """The reference's character loop, with a stray '}' ignored outside a record."""
    out, depth, buf = [], 0, ""
    for v in messages:
        if v is None:
            continue
        t = v.strip("".join(chr(i) for i in range(0x21)))
        if not t:
            continue
        for ch in t:
            if ch == "{":
                if depth == 0:
                    buf = ""
                depth += 1
                buf += ch
            elif ch == "}":
                if depth == 0:
                    continue
                depth -= 1
                buf += ch
                if depth == 0:
                    out.append(buf)
            elif depth > 0:
                buf += ch
    return out


ALPHABET = ['{', '}', '{"a":1}', '{"b":{"c":2}}', ' ', ',', '[', ']', 'x', '"s"', ':', '\t', '{"d":[{"e":3}]}']


def random_partition(rng, n_objects):
    text = "".join(rng.choice(ALPHABET) for _ in range(n_objects * 4))
    # cut anywhere, including inside objects; add tombstones and blanks
    cuts = sorted(rng.sample(range(1, max(len(text), 2)), k=min(len(text) - 1, rng.randint(0, 12)))) if len(text) > 1 else []
    msgs, last = [], 0
    for c in cuts + [len(text)]:
        msgs.append(text[last:c])
        last = c
    out = []
    for m in msgs:
        out.append(m)
        r = rng.random()
        if r < 0.1:
            out.append(None)
        elif r < 0.2:
            out.append("  ")
    return out


def _frame(spark, rows, **kw):
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    return frame_records(df, **kw)


def test_property_random_cuts(spark):
    rng = random.Random(7)
    rows, expected = [], {}
    for p in range(40):
        msgs = random_partition(rng, rng.randint(1, 30))
        off = 0
        for m in msgs:
            off += rng.randint(1, 3)  # offsets with gaps
            rows.append((None, None if m is None else m.encode(), "t", p, off, None))
        expected[p] = model(msgs)
    for block in (3, 1 << 20):  # many small blocks, and one block per partition
        got = {}
        for r in _frame(spark, rows, block_size=block).orderBy("partition", "offset", "pos").collect():
            got.setdefault(r.partition, []).append(r.record)
        for p in range(40):
            assert got.get(p, []) == expected[p], (block, p)
    # the token path alone gives the same records
    tok = {}
    for r in _frame(spark, rows, block_size=5, regex_fast_path=False).orderBy("partition", "offset", "pos").collect():
        tok.setdefault(r.partition, []).append(r.record)
    assert all(tok.get(p, []) == expected[p] for p in range(40))


def test_stray_brace_ignored_and_array_unwrapped(spark):
    rows = [(None, v.encode(), "t", 0, i, None) for i, v in enumerate(
        ['}', '{"a":1}', '[{"b":{"x":1}}, {"c":2}]', '  '])]
    recs = [r.record for r in _frame(spark, rows).orderBy("offset", "pos").collect()]
    assert recs == ['{"a":1}', '{"b":{"x":1}}', '{"c":2}']


def test_records_have_no_length_limit(spark):
    whole = '{"k":"' + "x" * 3_000_000 + '"}'
    cut = '{"k":"' + "y" * 2_500_000 + '"}'
    rows = [(None, whole.encode(), "t", 0, 1, None), (None, b'{"a":1}', "t", 0, 2, None)]
    rows += [(None, cut[i:i + 600_000].encode(), "t", 0, 3 + k, None) for k, i in enumerate(range(0, len(cut), 600_000))]
    rows += [(None, b'{"open":', "t", 0, 20, None)]
    out = [r.record for r in _frame(spark, rows, block_size=2).orderBy("offset").collect()]
    assert out == [whole, '{"a":1}', cut]


def test_pos_counts_records_of_a_message_on_both_paths(spark):
    rows = [(None, b'{"a":1} {"b":2} {"c":', "t", 0, 1, None), (None, b'3} {"d":4}', "t", 0, 2, None),
            (None, b'x {"e":1}, {"f":{"g":2}}', "t", 0, 3, None)]
    expected = [(1, 0, '{"a":1}'), (1, 1, '{"b":2}'), (1, 2, '{"c":3}'), (2, 0, '{"d":4}'), (3, 0, '{"e":1}'), (3, 1, '{"f":{"g":2}}')]
    for kw in ({}, {"fast_depth": 1}, {"regex_fast_path": False}):
        got = sorted((r.offset, r.pos, r.record) for r in _frame(spark, rows, **kw).collect())
        assert got == expected, kw


def test_token_walk_is_linear(spark):
    import time

    def seconds(text):
        df = spark.createDataFrame([(None, text.encode(), "t", 0, 1, None)], MESSAGE_SCHEMA)
        t = time.time()
        n = frame_records(df, block_size=8).count()
        return n, time.time() - t

    objects = '{"a":1}' * 40_000
    seconds(objects + "{")                       # compiles
    (n, plain), (m, tail) = seconds(objects), seconds(objects + '{"open":')
    assert n == m == 40_000 and tail < 2 * plain + 5


def test_malformed_bytes_do_not_move_cuts(spark):
    rng = random.Random(3)
    for _ in range(6):
        rows, expected = [], {}
        for p in range(20):
            data = b"".join(rng.choice([b'{"a":1}', b"{", b"}", b"\xe0", b"\xff\xfe", b"\xc3", "é".encode(), b'{"b":"\xe2\x82"}', b" "])
                            for _ in range(rng.randint(1, 30)))
            cuts = sorted(rng.sample(range(len(data) + 1), k=min(len(data), 3)))
            msgs = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
            rows += [(None, m, "t", p, i, None) for i, m in enumerate(msgs)]
            expected[p] = model([m.decode("utf-8", "replace") for m in msgs])
        got = {}
        for r in _frame(spark, rows).orderBy("partition", "offset", "pos").collect():
            got.setdefault(r.partition, []).append(r.record)
        for p in range(20):
            assert got.get(p, []) == expected[p], rows


def test_unplaced_messages_are_rejects(spark):
    from tripstream.operators.framing import unplaced_messages

    df = spark.createDataFrame([(None, b"x", None, 0, 1, None), (None, b"y", "t", 0, 1, None)], MESSAGE_SCHEMA)
    assert [(r.reason, r.record) for r in unplaced_messages(df).collect()] == [("unplaced", "x")]


def test_deep_object_goes_through_token_path(spark):
    deep = "{" * 12 + "}" * 12
    rows = [(None, (deep + deep).encode(), "t", 0, 1, None)]
    assert [r.record for r in _frame(spark, rows, fast_depth=4).collect()] == [deep, deep]


def test_counters_count_blank_not_null(spark):
    rows = [(None, b'{"a":1}', "t", 0, 1, None), (None, None, "t", 0, 2, None), (None, b"  ", "t", 0, 3, None)]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    c = framing_counters(df, frame_records(df)).first()
    assert (c.messages_in, c.objects_out) == (2, 1)
    assert decode_messages(df).count() == 1


def test_framing_plan_moves_the_text_once(spark):
    from tripstream.config import scratch_root

    path = scratch_root(spark, "plan")
    spark.createDataFrame([(None, b'{"a":1}', "t", p, o, None) for p in range(2) for o in range(50)],
                          MESSAGE_SCHEMA).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = frame_records(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan


def test_block_size_is_bounded_on_large_inputs(spark):
    import tripstream.operators.framing as fr

    # 2 ** 30 offsets: more blocks, not larger ones, so that a task's texts stay few
    rows = [(None, b"{}", "t", 0, o, None) for o in (0, (1 << 30) - 1)]
    assert fr.choose_block_size(spark.createDataFrame(rows, MESSAGE_SCHEMA), target_blocks=48) <= 1 << 17


def test_block_size_reads_no_payload(spark):
    from tripstream.config import scratch_root
    from tripstream.operators import framing as fr

    path = scratch_root(spark, "spans")
    spark.createDataFrame([(None, b"x", "t", 0, 5, None)], MESSAGE_SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    assert fr.choose_block_size(df) == fr.MIN_BLOCK
    plan = fr.placed(df).groupBy("topic", "partition").agg(F.max("offset"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in plan


def open_pieces(messages):
    """Offsets and texts of the messages of the record that never closes."""
    depth, kept = 0, []
    for off, v in messages:
        t = (v or "").strip("".join(chr(i) for i in range(0x21)))
        if not t:
            continue
        start = 0 if depth else None
        for i, ch in enumerate(t):
            if ch == "{":
                if depth == 0:
                    start, kept = i, []
                depth += 1
            elif ch == "}" and depth:
                depth -= 1
                if depth == 0:
                    start, kept = None, []
        if depth:
            kept.append((off, t[start:]))
    return kept if depth else []


def _with_open_record(rng):
    # a brace that never closes, early, then many messages inside it
    msgs = random_partition(rng, rng.randint(1, 5)) + ['{"never":'] + [
        rng.choice(['{"a":1}', "x" * rng.randint(1, 9), "}", "{", " "]) for _ in range(rng.randint(20, 60))]
    return msgs


def test_property_open_records_keep_all_their_pieces(spark):
    rng = random.Random(23)
    rows, parts = [], {}
    for p in range(30):
        msgs = _with_open_record(rng) if p % 3 == 0 else random_partition(rng, rng.randint(5, 40))
        off, parts[p] = 0, []
        for m in msgs:
            off += rng.randint(1, 2)
            parts[p].append((off, m))
            rows.append((None, None if m is None else m.encode(), "t", p, off, None))
    for block in (2, 5, 1 << 10):
        got, opened = {}, {}
        for r in _frame(spark, rows, block_size=block, emit_open=True).orderBy("partition", "offset", "pos").collect():
            (opened if r.open else got).setdefault(r.partition, []).append((r.offset, r.record) if r.open else r.record)
        for p, msgs in parts.items():
            assert got.get(p, []) == model([m for _, m in msgs]), (block, p)
            assert opened.get(p, []) == open_pieces(msgs), (block, p)


def test_never_closing_brace_spreads_over_segments(spark):
    from tripstream.operators import framing as fr

    msgs = ['{"a":1}', '{"open":'] + ['"' + "x" * 30 + '",'] * 200
    rows = [(None, m.encode(), "t", 0, i, None) for i, m in enumerate(msgs)]
    dec = fr.decode_messages(spark.createDataFrame(rows, MESSAGE_SCHEMA))
    prof = dec.select("topic", "partition", "offset", "text", F.lit(False).alias("fast"),
                      F.expr("size(regexp_extract_all(text, '[{]', 0)) - size(regexp_extract_all(text, '[}]', 0))").alias("a"))
    prof = prof.withColumn("m", F.least(F.lit(0), F.col("a")))
    segs = fr._segments(prof, 8).where("forced OR seg_start IS NOT NULL").count()
    assert segs > 20  # one segment per block
    assert [r.record for r in _frame(spark, rows, block_size=8).collect()] == ['{"a":1}']


def string_model(messages):
    """One character at a time: braces inside JSON strings do not count."""
    out, depth, quoted, escaped, buf = [], 0, False, False, ""
    for v in messages:
        for ch in (v or "").strip("".join(chr(i) for i in range(0x21))):
            if depth == 0:
                if ch == "{":
                    depth, buf = 1, ch
                continue
            buf += ch
            if quoted:
                if escaped:
                    escaped = False
                elif ch == "\\":
                    escaped = True
                elif ch == '"':
                    quoted = False
            elif ch == '"':
                quoted = True
            elif ch in "{}":
                depth += 1 if ch == "{" else -1
                if depth == 0:
                    out.append(buf)
    return out


STRINGS = ['{', '}', '"', '\\', '\\"', '\\\\', '{"a":"}"}', '{"b":{"c":"{\\"{"}}', '"{"', ' ', 'x', '\n', 'é',
           '{"k":"\\\\"}', '{"s":"a\\\\\\"}{"}', ',']


def _string_partition(rng, n):
    text = "".join(rng.choice(STRINGS) for _ in range(n))
    cuts = sorted(rng.sample(range(1, len(text)), k=min(len(text) - 1, rng.randint(0, 25)))) if len(text) > 1 else []
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


def test_string_aware_equals_sequential_model(spark):
    rng = random.Random(41)
    rows, expected = [], {}
    for p in range(60):
        msgs = _string_partition(rng, rng.randint(1, 60))
        off = 0
        for m in msgs:
            off += rng.randint(1, 3)
            rows.append((None, m.encode(), "t", p, off, None))
        expected[p] = string_model(msgs)
    assert any(string_model(m) != model(m) for m in [['{"a":"}"}']])
    for kw in ({"block_size": 3}, {"block_size": 11}, {}, {"block_size": 4, "regex_fast_path": False}):
        got = {}
        for r in _frame(spark, rows, string_aware=True, **kw).orderBy("partition", "offset", "pos").collect():
            got.setdefault(r.partition, []).append(r.record)
        for p in range(60):
            assert got.get(p, []) == expected[p], (kw, p)


def test_string_aware_open_pieces_and_deep_objects(spark):
    deep = '{"a":"}"' + ',"b":{"c":"{"' * 50 + "}" * 51
    msgs = ['{"x":"}', 'y"} z ' + deep + ' {"open":"', '}}', '\\', '"', '}"', "more"]
    rows = [(None, m.encode(), "t", 0, i, None) for i, m in enumerate(msgs)]
    for block in (2, 1 << 10):
        got = _frame(spark, rows, string_aware=True, block_size=block, emit_open=True).orderBy("offset", "pos").collect()
        assert [r.record for r in got if not r.open] == string_model(msgs) == ['{"x":"}y"}', deep]
        assert [(r.offset, r.record) for r in got if r.open] == [(1, '{"open":"'), *[(i, msgs[i]) for i in range(2, 7)]]


def test_string_aware_moves_the_text_once(spark):
    from tripstream.config import scratch_root

    path = scratch_root(spark, "plan")
    spark.createDataFrame([(None, b'{"a":"}"}', "t", p, o, None) for p in range(2) for o in range(50)],
                          MESSAGE_SCHEMA).write.parquet(path)
    plan = frame_records(spark.read.parquet(path), string_aware=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan


def _long_partition(n=300):
    """A record that opens with the first message and closes with the last."""
    return ['{"a":1} {"long":['] + [f'"x{i}",' for i in range(n)] + ['1]} {"b":2}', '{"c":3}']


def test_record_over_many_blocks_is_joined_or_given_out_in_pieces(spark):
    msgs = _long_partition()
    rows = [(None, m.encode(), "t", 0, i, None) for i, m in enumerate(msgs)]
    want = model(msgs)
    for kw in ({"block_size": 8}, {"block_size": 1 << 10}, {"block_size": 8, "string_aware": True}):
        got = _frame(spark, rows, **kw).orderBy("offset", "pos").collect()
        assert [(r.offset, r.pos, r.record) for r in got] == [(0, 0, want[0]), (0, 1, want[1]), (301, 0, want[2]), (302, 0, want[3])]
        short = _frame(spark, rows, max_record_chars=100, emit_long=True, **kw)
        got = short.orderBy("offset", "pos", "piece_offset").collect()
        assert [r.record for r in got if r.piece_offset is None] == [want[0], *want[2:]]
        pieces = sorted((r for r in got if r.piece_offset is not None), key=lambda r: r.piece_offset)
        assert "".join(r.record for r in pieces) == want[1] and {r.offset for r in pieces} == {0} and len(pieces) == 302
        assert [r.record for r in _frame(spark, rows, max_record_chars=100, **kw).orderBy("offset").collect()] == [want[0], *want[2:]]


def test_pieces_of_a_partition_long_record_are_spread(spark):
    """A stray ``{`` at the start and a ``}`` at the end: no task holds it all."""
    msgs = ["{"] + ['{"a":1}'] * 4000 + ["}"]
    rows = [(None, m.encode(), "t", 0, i, None) for i, m in enumerate(msgs)]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    out = frame_records(df, block_size=64, max_record_chars=1000, emit_long=True)
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 4002 and max(r["count"] for r in per_task) < 1200
    assert "".join(r.record for r in out.orderBy("piece_offset").collect()) == "".join(msgs)
    from tripstream.operators import framing as fr

    # every block is a segment of its own
    prof = fr.decode_messages(df).select("topic", "partition", "offset", "text", F.lit(False).alias("fast"),
                                         F.expr(fr._PROFILE_SQL).alias("p")).select("*", "p.a", "p.m")
    assert fr._segments(prof, 64).count() == 63


def test_property_long_and_open_records(spark):
    rng = random.Random(77)
    rows, parts = [], {}
    for p in range(20):
        msgs = _with_open_record(rng) + (["}"] * rng.choice([0, 60]) if p % 2 else [])
        off, parts[p] = 0, []
        for m in msgs:
            off += rng.randint(1, 2)
            parts[p].append((off, m))
            rows.append((None, None if m is None else m.encode(), "t", p, off, None))
    for block in (2, 7):
        got, opened, long = {}, {}, {}
        for r in _frame(spark, rows, block_size=block, emit_open=True, emit_long=True, max_record_chars=40).collect():
            if r.piece_offset is not None:
                long.setdefault((r.partition, r.offset), []).append((r.piece_offset, r.record))
            else:
                (opened if r.open else got).setdefault(r.partition, []).append((r.offset, r.pos, r.record))
        for p, msgs in parts.items():
            whole = [x for _, _, x in sorted(got.get(p, []))]
            joined = ["".join(t for _, t in sorted(v)) for (q, _), v in long.items() if q == p]
            want = model([m for _, m in msgs])
            assert whole == [x for x in want if len(x) <= 40] and sorted(joined) == sorted(x for x in want if len(x) > 40)
            assert [(o, t) for o, _, t in sorted(opened.get(p, []))] == open_pieces(msgs), (block, p)


def test_string_aware_steps_equal_sequential_model():
    """What is known of a message from its codes, for every state, and of a block of them."""
    import re

    from tripstream.operators import quoted as q

    def codes_of(text):
        return re.sub(r'(?s)\\[^{}"]|[^{}"\\]+', "", text)

    def walk(text, s):
        touched, top = s == 0, s
        for c in text:
            if s % 3 == 2:
                s -= 1
            elif s % 3 == 1:
                s += 1 if c == "\\" else -1 if c == '"' else 0
            elif s == 0:
                s = 3 if c == "{" else 0
            else:
                s += {"{": 3, "}": -3, '"': 1}.get(c, 0)
            touched, top = touched or s == 0, max(top, s)
        return s, touched, top // 3

    rng = random.Random(51)
    for _ in range(400):
        msgs = ["".join(rng.choice('{{}}""\\\\xn ') for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 12))]
        items = [(codes_of(m), codes_of(m[1:]) if m[0] in '{}"\\' else None) for m in msgs]
        function = q.block_function(items)
        for start in (0, *range(3, 30)):
            s = start
            for m, (codes, escaped) in zip(msgs, items):
                assert q._state_after(codes, escaped, s)[:2] == walk(m, s)[:2], (m, s)
                s, _, top = walk(m, s)
            assert q.applied(function, start) == s, (msgs, start)


def test_string_aware_spreads_its_walks(spark):
    """Blocks' walks are not put together into a few tasks because their codes are few bytes."""
    from tripstream.operators import quoted as q

    rows = [(None, b'{"a":"}"} {"b":', "t", p, o, None) for p in range(2) for o in range(400)]
    dec = decode_messages(spark.createDataFrame(rows, MESSAGE_SCHEMA))
    blocks, met = q.locate(dec, 16, lambda t, n: F.broadcast(t))
    assert blocks.count() == 50 and met.count() == 800
    assert met.select(F.spark_partition_id()).distinct().count() >= 16
