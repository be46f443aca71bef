"""Stream ingest: stream = batch, and a record cut between two runs survives."""

import time

import pytest
from pyspark.sql import functions as F

from tripstream.config import scratch_root
from tripstream.operators.framing import frame_records
from tripstream.operators.parse import parse_records
from tripstream.operators.quality import good_rows
from tripstream.plans.common import fixed_now
from tripstream.sinks.snapshot_table import SnapshotTable
from tripstream.sources.feed import trip_messages
from tripstream.streaming.ingest import kafka_options, message_file_stream, run_until_done, start_ingest

SF = "/root/testdata/sf0.001"


def _write_ranges(msgs, path, cuts):
    for lo, hi in zip(cuts, cuts[1:]):
        (msgs.where((F.col("offset") >= lo) & (F.col("offset") < hi))
         .repartition("topic", "partition").sortWithinPartitions("offset")
         .write.mode("append").parquet(path))
        time.sleep(0.02)


def test_stream_equals_batch_across_restart(spark):
    root = scratch_root(spark, "test-stream")
    msgs = trip_messages(spark.read.parquet(f"{SF}/events.parquet"))
    top = msgs.agg(F.max("offset")).first()[0] + 1
    # event i owns offsets 8*(i div 4) + k; a split object uses k = 0, 1.
    # 417 cuts event 210's object between micro-batches, 1009 cuts event
    # 504's object between the two runs of the query.
    _write_ranges(msgs, f"{root}/in", [0, 417, 1009])
    table = SnapshotTable(spark, f"{root}/table")
    src = message_file_stream(spark, f"{root}/in", max_files_per_trigger=2)
    run_until_done(start_ingest(src, table, f"{root}/ckpt", trigger={"availableNow": True}, now=fixed_now()))
    first = table.current().count()
    # second run, same checkpoint: the rest of the offsets
    _write_ranges(msgs, f"{root}/in", [1009, top])
    src = message_file_stream(spark, f"{root}/in", max_files_per_trigger=2)
    run_until_done(start_ingest(src, table, f"{root}/ckpt", trigger={"availableNow": True}, now=fixed_now()))
    batch = good_rows(parse_records(frame_records(msgs), now=fixed_now()))
    stream = table.current()
    assert first < stream.count()
    assert stream.count() == batch.count() == 1000
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_kafka_options():
    o = kafka_options()
    assert o["subscribe"] == "new-york-data" and o["startingOffsets"] == "earliest"
    assert o["kafka.bootstrap.servers"] == "localhost:9092" and o["kafka.group.id"] == "iceberg-kafka-group"


def _batches(spark, carry, batches, first=0):
    from tripstream.schema import MESSAGE_SCHEMA
    from tripstream.streaming.ingest import frame_micro_batch

    out = []
    for bid, rows in enumerate(batches, first):
        df = spark.createDataFrame([(None, t.encode(), "t", 0, o, None) for t, o in rows], MESSAGE_SCHEMA)
        recs = frame_micro_batch(df, carry, bid)
        out += [(r.offset, r.pos, r.record) for r in recs.orderBy("offset", "pos").collect()]
        recs.unpersist()
    return out


def test_carry_keeps_a_long_record_whole(spark):
    long_rec = '{"k":{"x":"' + "x" * 60_000 + '"},"z":1}'
    short = '{"a":{"b":2}}'
    batches = [
        [('{"first":0} ' + long_rec[:25], 1)],                  # opens, depth 2
        [(long_rec[25:30_000], 2), (short[:5], 3)],             # still inside the long record
        [(long_rec[30_000:], 4), (short[5:] + " {}", 5), ('{"c":3}', 6)],
    ]
    # the short object's text sits inside the long record's braces, so it is part of it
    whole = long_rec[:30_000] + short[:5] + long_rec[30_000:] + short[5:]
    assert _batches(spark, scratch_root(spark, "test-carry"), batches) == [
        (1, 0, '{"first":0}'), (1, 1, whole), (5, 0, "{}"), (6, 0, '{"c":3}')]


def test_lost_carry_raises(spark):
    carry = scratch_root(spark, "test-carry")
    _batches(spark, carry, [[('{"a":', 1)]])
    with pytest.raises(Exception, match="lost"):
        _batches(spark, carry, [[("1}", 2)]], first=3)
    with pytest.raises(Exception):
        _batches(spark, scratch_root(spark, "test-none"), [[("1}", 2)]], first=1)
    # a replayed batch reads its predecessor again
    assert _batches(spark, carry, [[("1}", 2)]], first=1) == _batches(spark, carry, [[("1}", 2)]], first=1) == [(1, 0, '{"a":1}')]


def test_counters_of_a_stream_by_a_listener(spark):
    """Counts without a job of their own, rates, and the query's progress."""
    from tripstream.operators.framing import framing_counters
    from tripstream.streaming.counters import StreamCounters

    root = scratch_root(spark, "test-counters")
    msgs = trip_messages(spark.read.parquet(f"{SF}/events.parquet"), faults=True)
    top = msgs.agg(F.max("offset")).first()[0] + 1
    _write_ranges(msgs, f"{root}/in", [0, 417, 1009, top])        # cuts lie inside objects: pieces are carried
    counters, calls = StreamCounters(), []
    src = message_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = start_ingest(src, SnapshotTable(spark, f"{root}/table"), f"{root}/ckpt", trigger={"availableNow": True},
                     now=fixed_now(), counters=counters, on_counters=lambda b, c: calls.append((b, c)))
    run_until_done(q)
    want = framing_counters(msgs, frame_records(msgs)).first()
    rows, t = counters.batches(), counters.totals()
    assert len(rows) == len(calls) >= 3 and [r["batch_id"] for r in rows] == list(range(len(rows)))
    assert (t["messages_in"], t["objects_out"]) == (want.messages_in, want.objects_out) == (sum(r["messages_in"] for r in rows), 1000)
    assert t["total"] == t["success"] + t["failure"] == 1000 and t["failure"] > 0
    assert t["success_pct"] == round(t["success"] / 10, 1) and t["null_pct"] == round(t["failure"] / 10, 2)
    deadline = time.time() + 20
    while not all("duration_ms" in r for r in counters.batches()) and time.time() < deadline:
        time.sleep(0.2)                                             # progress comes after the batch
    assert all(r["duration_ms"] > 0 and r["processed_rows_per_second"] > 0 for r in counters.batches())
    counters.detach()


def test_counting_runs_no_job(spark):
    """The observed counts are there after the jobs that frame and write the batch."""
    from pyspark.sql import Observation

    from tripstream.schema import MESSAGE_SCHEMA
    from tripstream.streaming.ingest import frame_micro_batch

    df = spark.createDataFrame([(None, b'{"a":1}{"b"', "t", 0, 1, None), (None, b":2}", "t", 0, 2, None),
                                (None, b" ", "t", 0, 3, None), (None, None, "t", 0, 4, None)], MESSAGE_SCHEMA)
    seen, framed = Observation(), Observation()
    recs = frame_micro_batch(df, scratch_root(spark, "test-seen"), 0, seen, framed)
    assert seen.get == {"messages_in": 3} and framed.get == {"objects_out": 2}
    recs.unpersist()


def test_long_record_becomes_reject_pieces(spark, monkeypatch):
    from tripstream.operators import framing

    monkeypatch.setattr(framing.frame_records, "__defaults__",
                        tuple(50 if x == framing.MAX_RECORD_CHARS else x for x in framing.frame_records.__defaults__))
    root = scratch_root(spark, "test-long")
    text = ['{"tripID":"', "x" * 30, "y" * 30, '"}', '{"tripID":""}']
    from tripstream.schema import MESSAGE_SCHEMA

    spark.createDataFrame([(None, t.encode(), "t", 0, i, None) for i, t in enumerate(text)], MESSAGE_SCHEMA).write.parquet(f"{root}/in")
    table = SnapshotTable(spark, f"{root}/table")
    run_until_done(start_ingest(message_file_stream(spark, f"{root}/in"), table, f"{root}/ckpt", trigger={"availableNow": True}))
    rows = table.rejects().orderBy("piece_offset").collect()
    assert "".join(r.record for r in rows if r.reason == "long_record") == "".join(text[:4])
    assert {r.offset for r in rows if r.reason == "long_record"} == {0} and len(rows) == 5


def test_batches_of_which_nothing_comes_out(spark):
    from tripstream.schema import MESSAGE_SCHEMA
    from tripstream.streaming.counters import StreamCounters

    root, counters = scratch_root(spark, "test-nothing"), StreamCounters()
    for k, value in enumerate([b"  ", b'{"open"', None, b":1"]):
        spark.createDataFrame([(None, value, "t", 0, k, None)], MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        time.sleep(0.02)
    table = SnapshotTable(spark, f"{root}/table")
    run_until_done(start_ingest(message_file_stream(spark, f"{root}/in", 1), table, f"{root}/ckpt",
                                trigger={"availableNow": True}, counters=counters))
    counters.detach()
    t = counters.totals()
    assert (t["batches"], t["messages_in"], t["objects_out"], t["total"], t["success_pct"]) == (4, 3, 0, 0, 0.0)
    assert table.current().count() == 0
