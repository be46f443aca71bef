"""Snapshot table: append, replay, time travel rules, catalog and fallbacks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripstream.config import scratch_root
from tripstream.schema import TRIP_COLUMNS
from tripstream.sinks.snapshot_table import SnapshotNotFound, SnapshotTable
from tripstream.sources.tables import TableService

D = dt.datetime


def trips(spark, n, start=0, day=1):
    rows = [(f"t{i}", "1", D(2024, 1, day, 1), D(2024, 1, day, 2), str(i % 3), "1.0", "1", "N", "1", "2",
             "card", "{}", "{}") for i in range(start, start + n)]
    return spark.createDataFrame(rows, ",".join(f"{c} {'timestamp_ntz' if 'datetime' in c else 'string'}"
                                                for c in TRIP_COLUMNS))


@pytest.fixture()
def table(spark):
    t = SnapshotTable(spark, scratch_root(spark, "test-table"))
    assert t.ensure() is True and t.ensure() is False
    t.append(trips(spark, 5, 0, 1), batch_id=10, snapshot_id=300, committed_at=D(2024, 2, 1))
    t.append(trips(spark, 7, 5, 2), batch_id=11, snapshot_id=100, committed_at=D(2024, 2, 2))
    t.append(trips(spark, 11, 12, 3), batch_id=12, snapshot_id=200, committed_at=D(2024, 2, 3))
    return t


def test_append_and_replay(spark, table):
    again = table.append(trips(spark, 99), batch_id=11)
    assert again.snapshot_id == 100
    assert table.log().count() == 3 and table.current().count() == 23
    log = {r.snapshot_id: r for r in table.log().collect()}
    assert log[100].parent_id == 300 and log[300].parent_id is None and log[200].added_rows == 11


def test_time_travel_rules(spark, table):
    assert table.as_of(snapshot_id=100).count() == 12
    assert table.as_of(timestamp=D(2024, 2, 1, 12)).count() == 5
    assert table.as_of(timestamp="2024-02-02 00:00:00").count() == 12
    assert table.as_of().count() == 12                       # previous snapshot
    assert table.as_of(snapshot_id=300, timestamp=D(2024, 2, 3)).count() == 5  # id first
    with pytest.raises(SnapshotNotFound):
        table.as_of(snapshot_id=42)
    assert table.as_of(snapshot_id=42, on_error="current").count() == 23
    with pytest.raises(SnapshotNotFound):
        table.as_of(timestamp=D(2023, 1, 1))


def test_as_of_prunes_partitions(spark, table):
    plan = table.as_of(snapshot_id=100)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_seq" in plan and "<= 2)" in plan


def test_one_snapshot_previous_is_current(spark):
    t = SnapshotTable(spark, scratch_root(spark, "test-one"))
    t.append(trips(spark, 4), batch_id=0)
    assert t.as_of().count() == 4


def test_uncommitted_data_invisible(spark, table):
    # a failed try left files for sequence 4 without a commit row
    trips(spark, 3).withColumn("pickup_day", F.to_date("tpep_pickup_datetime")).write.partitionBy(
        "pickup_day").parquet(f"{table.data_path}/snapshot_seq=4")
    assert table.current().count() == 23
    table.append(trips(spark, 2), batch_id=13)      # the retry overwrites sequence 4
    assert table.current().count() == 25


def test_days_are_partitions(spark, table):
    days = {r.pickup_day.day: r.trips for r in
            __import__("tripstream.operators.reports", fromlist=["x"]).rows_per_day(table).collect()}
    assert days == {1: 5, 2: 7, 3: 11}


def test_table_service_fallbacks(spark, table):
    svc = TableService(spark, "svc_trips", table.path)
    assert svc.get_table().count() == 23             # by path
    assert svc.register() is True
    assert spark.table("svc_trips").count() == 23     # by name
    empty = TableService(spark, "nope_trips", scratch_root(spark, "nothing")).get_table()
    assert empty.count() == 0 and empty.columns == TRIP_COLUMNS
    out = TableService(spark, "missing_trips", table.path).execute_query(
        "SELECT passenger_count, COUNT(*) AS n FROM missing_trips GROUP BY passenger_count")
    assert sum(r.n for r in out.collect()) == 23
    with pytest.raises(Exception):
        svc.execute_query("SELEC broken")


def test_query_report(spark, table):
    from tripstream.jobs import query_report

    rep = query_report(spark, table, name="report_trips")
    assert list(rep) == ["namespaces", "tables", "first_rows", "count", "trips_per_passenger_count",
                         "distance_over_5_text", "snapshots_by_time", "as_of_min_snapshot", "history", "snapshots"]
    assert rep["count"].first().row_count == 23
    assert rep["as_of_min_snapshot"].count() == 10       # min id 100 is the second snapshot: 12 rows, limit 10
    assert [r.snapshot_id for r in rep["snapshots_by_time"].collect()] == [300, 100, 200]


def test_two_queries_with_the_same_batch_ids(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.append(trips(spark, 7), batch_id=0, query_id="a")
    t.append(trips(spark, 5, 10), batch_id=0, query_id="b")
    t.append(trips(spark, 5, 10), batch_id=0, query_id="b")      # replay
    t.append(trips(spark, 1, 20), batch_id=0)
    assert t.current().count() == 13 and t.log().count() == 3


def test_empty_first_append_reads_as_no_rows(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.append(trips(spark, 5).limit(0), batch_id=0)
    assert t.current().count() == 0 and t.rejects().count() == 0
    t.append(trips(spark, 5), batch_id=1)
    assert t.current().count() == 5


def test_name_sees_later_appends(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    assert t.register("later_rows")
    assert spark.table("later_rows").count() == 0
    t.append(trips(spark, 3))
    assert spark.table("later_rows").count() == 3
    t.append(trips(spark, 4, 10))
    assert spark.table("later_rows").count() == 7
    spark.sql("DROP VIEW later_rows")


def test_pickup_range_prunes_days(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.append(trips(spark, 5))
    df = t.between(D(2024, 1, 1), D(2024, 1, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "pickup_day" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_written_files_have_the_settings(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from tripstream.sinks.snapshot_table import WriteTuning

    t = SnapshotTable(spark, f"{tmp_path}/t", WriteTuning.reference())
    t.append(trips(spark, 9000))
    files = glob.glob(f"{tmp_path}/t/data/snapshot_seq=1/*/*.parquet")
    assert files
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            assert meta.row_group(g).column(0).compression == "ZSTD"
            assert meta.row_group(g).total_byte_size <= 5242880


@pytest.mark.parametrize("chars", [4, 600])
def test_files_are_of_the_target_size_in_bytes(spark, tmp_path, chars):
    import glob
    import os

    from tripstream.sinks.snapshot_table import WriteTuning

    target = 100_000
    n = 60_000 if chars < 10 else 3_000
    rows = spark.range(n).select(
        *[(F.expr(f"timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, CAST(id % 3 AS INT))") if "datetime" in c else
           F.substring(F.repeat(F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256), 10), 1, chars)).alias(c)
          for c in TRIP_COLUMNS])
    t = SnapshotTable(spark, f"{tmp_path}/t", WriteTuning(target_file_bytes=target))
    t.append(rows)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/t/data/snapshot_seq=1/*/*.parquet")]
    assert len(sizes) >= 6 and all(0.5 * target <= x <= 1.5 * target for x in sizes), sizes
    assert t.current().count() == n and t.current().exceptAll(rows).count() == 0


def test_new_batch_is_known_from_the_newest_commit(spark, tmp_path, monkeypatch):
    from tripstream.sinks import snapshot_table as st

    monkeypatch.setattr(st, "LOG_EPOCH", 3)
    t = SnapshotTable(spark, f"{tmp_path}/t")
    for k in range(8):
        t.append(trips(spark, 1, k), batch_id=k, query_id="a" if k % 2 else "b")
    assert t.last_seq() == 8 and t.last_commit().batches == {"a": 7, "b": 6}
    read = []
    monkeypatch.setattr(SnapshotTable, "log", lambda self: read.append(1))       # the whole log is not asked for
    assert t.committed(8, "a") is None and t.committed(7, "a").snapshot_seq == 8 and not read
    t.append(trips(spark, 1, 9), batch_id=8, query_id="b")
    assert not read and t.last_seq() == 9
    plan = spark.read.schema(st.COMMIT_SCHEMA).parquet(t._commit_path(9))
    assert len(plan.inputFiles()) == 1
    monkeypatch.undo()
    t = SnapshotTable(spark, f"{tmp_path}/t")


def test_older_batch_is_looked_for_in_the_log(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t")
    for k in (5, 9, 2):                       # ids need not rise
        assert t.append(trips(spark, 1, k), batch_id=k).batch_id == k
    assert [t.append(trips(spark, 9), batch_id=k).snapshot_seq for k in (9, 2, 5)] == [2, 3, 1]
    assert t.current().count() == 3


def test_broken_commit_is_not_seen(spark, tmp_path):
    import os

    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.append(trips(spark, 3))
    os.makedirs(f"{tmp_path}/t/commits/log_epoch=0/commit=2/_temporary")
    assert t.last_seq() == 1 and t.log().count() == 1
    t.append(trips(spark, 4))
    assert t.last_seq() == 2 and t.current().count() == 7


def test_plain_predicate_prunes_days(spark, table):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")

    def folders(df):
        return df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("PushedFilters")[0]

    df = table.where("tpep_pickup_datetime >= '2024-01-02' AND tpep_pickup_datetime < '2024-01-02 12:00:00'")
    assert "pickup_day" in folders(df) and "2024-01-02" in folders(df) and df.count() == 7
    assert "pickup_day" not in folders(table.where("passenger_count = '1'"))
    assert "pickup_day" in folders(table.where(F.to_date("tpep_pickup_datetime") == "2024-01-03"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_random_predicates_equal_unpruned_reads(spark, tmp_path):
    import random

    rng = random.Random(6)
    t = SnapshotTable(spark, f"{tmp_path}/t")
    base = trips(spark, 60)
    t.append(base.withColumn("tpep_pickup_datetime", F.expr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(substring(tripID, 2) AS INT) % 9, CAST(substring(tripID, 2) AS INT) % 24, 0, 0)")))
    whole = t.current().cache()
    col = "tpep_pickup_datetime"

    def moment():
        return f"2024-01-{rng.randint(1, 10):02d} {rng.choice(['00:00:00', '12:30:00', '23:59:59'])}"

    def condition(depth):
        if depth and rng.random() < 0.6:
            return f"({condition(depth - 1)} {rng.choice(['AND', 'OR'])} {condition(depth - 1)})"
        return rng.choice([
            f"{col} {rng.choice(['<', '<=', '>', '>=', '=', '<=>'])} TIMESTAMP_NTZ'{moment()}'",
            f"'{moment()}' {rng.choice(['<', '<=', '>', '>='])} {col}",
            f"{col} BETWEEN TIMESTAMP_NTZ'{moment()}' AND TIMESTAMP_NTZ'{moment()}'",
            f"to_date({col}) IN (DATE'2024-01-0{rng.randint(1, 9)}', DATE'2024-01-0{rng.randint(1, 9)}')",
            f"{col} > timestamp'{moment()}'", f"NOT ({col} < TIMESTAMP_NTZ'{moment()}')", f"{col} IS NOT NULL",
            "passenger_count = '1'", f"hour({col}) = 3", f"{col} = NULL", f"CAST({col} AS DATE) >= '2024-01-0{rng.randint(1, 9)}'"])

    for _ in range(60):
        cond = condition(3)
        assert sorted(r.tripID for r in t.where(cond).collect()) == sorted(r.tripID for r in whole.where(cond).collect()), cond


def test_time_travel_functions_of_sql(spark, table):
    table.register_functions("tt")

    def n(call):
        return spark.sql(f"SELECT COUNT(*) FROM {call}").first()[0]

    assert n("tt_as_of(100)") == 12 and n("tt_as_of(300)") == 5 and n("tt_at(TIMESTAMP_NTZ'2024-02-02 00:00:00')") == 12
    assert n("tt_at(TIMESTAMP_NTZ'2024-02-01 12:00:00')") == 5 and n("tt_at(TIMESTAMP_NTZ'2025-01-01')") == 23
    assert n("tt_between(TIMESTAMP_NTZ'2024-01-02', TIMESTAMP_NTZ'2024-01-03')") == 7
    table.append(trips(spark, 4, 50, 2), batch_id=14, snapshot_id=77, committed_at=D(2024, 2, 4))
    assert n("tt_as_of(77)") == 27                      # later appends are seen
    plan = spark.sql("SELECT tripID FROM tt_as_of(100)")._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_seq" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0] and "Subquery" in plan
    for call in ("tt_as_of(42)", "tt_at(TIMESTAMP_NTZ'2023-01-01')"):
        with pytest.raises(Exception, match="commit|committed"):
            n(call)


def test_describe_follows_the_table(spark, table):
    svc = TableService(spark, "described_trips", table.path)
    svc.register()
    rows = {r.col_name: (r.data_type, r.partition_key) for r in svc.describe().collect()}
    assert list(rows)[:13] == TRIP_COLUMNS and rows["tripID"] == ("string", False)
    assert rows["snapshot_seq"] == ("int", True) and rows["pickup_day"] == ("date", True)
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW described_other AS SELECT 1 AS a, DATE'2024-01-01' AS b")
    other = TableService(spark, "described_other", scratch_root(spark, "none"))
    assert [tuple(r) for r in other.describe().collect()] == [("a", "int", False), ("b", "date", False)]
    with pytest.warns(UserWarning, match="no table"):
        assert TableService(spark, "described_nothing", scratch_root(spark, "none")).describe().count() == 0


def test_rejects_hold_the_whole_text(spark, tmp_path):
    from tripstream.operators.parse import parse_records

    text = '{"tripID":' + "x" * 1000 + "}"
    recs = spark.createDataFrame([("t", 0, 1, 0, text)], "topic string, partition int, offset long, pos int, record string")
    t = SnapshotTable(spark, f"{tmp_path}/t")
    t.append_checked(parse_records(recs))
    r = t.rejects().first()
    assert r.record == text and r.reason == "bad_json" and "more bytes" in r.raw_preview
