"""How the plans get at their inputs: once, and from all cores."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tripstream.plans import common as C
from tripstream.sources.feed import FeedRules


def test_feed_is_made_on_all_cores(spark):
    # the events are one small file, so one task read them and made all messages
    msgs = C.messages(spark, SF_SMALL, FeedRules(pack=False))
    tasks = msgs.groupBy(F.spark_partition_id()).count().count()
    assert tasks >= spark.sparkContext.defaultParallelism


def test_staged_rows_are_computed_once(spark):
    rows = spark.range(1000).select("id", F.rand().alias("x"), (F.col("id") % 3).cast("int").alias("b"),
                                    F.lit(None).cast("timestamp_ntz").alias("t"))
    for by in (None, "b"):
        once = C.staged(rows, "staged-test", by=by)
        assert sorted(once.dtypes) == sorted(rows.dtypes)
        assert sorted(once.collect(), key=lambda r: r.id) == sorted(once.collect(), key=lambda r: r.id)
    assert once.where("b = 1").count() == 333


def test_fixture_table_keeps_no_rows_cached(spark):
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    seen, before = [], cached()
    append = C.SnapshotTable.append

    def watched(self, *args, **kw):
        seen.append(cached())
        return append(self, *args, **kw)

    C.SnapshotTable.append = watched
    try:
        C._TABLES.clear()
        t = C.fixture_table(spark, SF_SMALL)
    finally:
        C.SnapshotTable.append = append
    assert len(seen) == 3 and max(seen) <= before
    assert t.current().count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_rows_of_two_appends_are_staged(spark, monkeypatch):
    from tripstream.plans import queries as Q

    labels, staged = [], C.staged
    monkeypatch.setattr(C, "staged", lambda rows, label, by=None: labels.append(label) or staged(rows, label, by))
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    got = {r.method: r.row_count for r in Q.q_table_fallback(spark, SF_SMALL).collect()}
    assert labels == ["named-rows"] and got["path"] == got["name"] == n


def test_stream_feeds_are_staged(spark, monkeypatch):
    from tripstream.plans import queries as Q

    labels, staged = [], C.staged
    monkeypatch.setattr(C, "staged", lambda rows, label, by=None: labels.append(label) or staged(rows, label, by))
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert {r.item: r.row_count for r in Q.q_two_streams_one_table(spark, SF_SMALL).collect()}["rows"] == n
    assert sum(r.trips for r in Q.q_stream_ingest(spark, SF_SMALL).collect()) == n
    assert labels == ["two-feed", "stream-feed"]
