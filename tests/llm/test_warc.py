import base64
import hashlib

import zstandard
from pyspark.sql import functions as F

from tripstream.config import scratch_root
from tripstream.llm import warc
from tripstream.llm.common import ready, written

SCHEMA = "page_id long, url string, html string"


def archive(spark, rows, **options):
    ready(spark)
    pages = written(spark.createDataFrame(rows, SCHEMA), "pages") if rows else spark.createDataFrame([], SCHEMA)
    folder = scratch_root(spark, "warc-test")
    return pages, folder, warc.write_bundles(warc.dedupe_payloads(pages), folder, **options)


def test_round_trip_and_revisits(spark):
    long_text = "é" * 300_000
    rows = [(1, "http://a/", "x"), (2, "http://b/ \n", "x"), (3, None, None), (4, "u", ""), (5, "u", long_text),
            (5, "u", long_text), (6, "u", "WARC/1.1\r\n\r\nWARC/1.1"), (None, "u", "none")]
    _, folder, index = archive(spark, rows, frame_bytes=2000)
    got = [r.asDict() for r in warc.read_bundles(index, folder, frames_per_task=2).collect()]
    assert len(got) == len(rows)
    body = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        b = body[r["page_id"]]
        assert r["payload_bytes"] == len(b)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(b).digest()).decode()
        if r["record_type"] == "response":
            assert r["refers_to"] is None and r["content_sha1"] == r["payload_digest"]
        else:
            assert r["content_bytes"] == 0
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in got)
    assert kinds == [(-1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "response", None),
                     (4, "revisit", 3), (5, "response", None), (5, "revisit", 5), (6, "response", None)]
    assert len({r["record_id"] for r in got}) == len(rows)


def test_seekable_format_and_lookup(spark):
    rows = [(i, f"http://h/{i}", f"text {i} " * 50) for i in range(200)]
    _, folder, index = archive(spark, rows, frame_bytes=4000)
    for (name,) in index.select("bundle").distinct().collect():
        data = open(name, "rb").read()
        with open(name, "rb") as f:
            table = warc.seek_table(f, len(data))
        assert len(table) > 1
        # any decompressor reads the whole file; frames are independent
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert plain == b"".join(zstandard.ZstdDecompressor().decompress(data[a:a + p]) for a, p, _ in table)
    some = index.where(F.col("page_id") % 50 == 0)
    got = warc.fetch_records(index, folder, some.select("record_id")).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in got) == [(i, f"text {i} " * 50) for i in (0, 50, 100, 150)]


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], SCHEMA)
    got = warc.dedupe_payloads(pages, min_revisit_bytes=3).select("page_id", "is_revisit", "refers_to").collect()
    assert sorted(map(tuple, got)) == [(1, False, None), (2, False, None), (3, False, None), (4, True, 3)]


def test_empty_table(spark):
    _, folder, index = archive(spark, [])
    assert index.count() == 0 and warc.read_bundles(index, folder).count() == 0


def test_read_has_a_task_for_each_run_of_frames(spark):
    rows = [(i, "u", f"text {i} " * 50) for i in range(300)]
    _, folder, index = archive(spark, rows, frame_bytes=4000)
    frames = sum(r.n for r in index.groupBy("bundle").agg(F.max("n_frames").alias("n")).collect())
    tasks = {k: warc.read_bundles(index, folder, frames_per_task=k).rdd.getNumPartitions() for k in (1, 4)}
    assert tasks[1] == frames and frames / 4 <= tasks[4] <= frames / 4 + index.select("bundle").distinct().count()


def test_payloads_are_not_shuffled(spark):
    ready(spark)
    rows = [(i, "u", "" if i % 3 == 0 else f"t{i % 50}") for i in range(300)]
    pages = written(spark.createDataFrame(rows, SCHEMA), "pages")
    plan = warc.dedupe_payloads(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_many_repeated_payloads_meet_by_row(spark, monkeypatch, clashing):
    ready(spark)
    rows = [(i, "u", "" if i % 3 == 0 else f"t{i % 50}") for i in range(300)]
    pages = clashing(written(spark.createDataFrame(rows, SCHEMA), "pages"))
    cols = ["page_id", "payload", "refers_to", "is_revisit", "is_named"]
    few = sorted(map(tuple, warc.dedupe_payloads(pages).select(*cols).collect()))
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, warc.dedupe_payloads(pages).select(*cols).collect())) == few
    assert sum(r[3] for r in few) == 300 - len({h for _, _, h in rows})
