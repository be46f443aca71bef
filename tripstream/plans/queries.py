"""The registered queries: one per operator group of the survey's inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame; all read the given
tables (``events``, ``documents``) or data Spark derives from them.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripstream.config import scratch_root
from tripstream.functions.dates import format_datetime, parse_lenient, parse_strict, epoch_millis_to_ntz
from tripstream.functions import sql as sql_functions
from tripstream.functions.nested import json_field, same_json
from tripstream.functions.text import preview
from tripstream.operators import reports, sequential
from tripstream.operators.framing import RECORD_SCHEMA, decode_messages, frame_records, framing_counters
from tripstream.operators.parse import parse_records
from tripstream.operators.quality import filter_counters, good_rows, mapper_counters, reject_report
from tripstream.plans import common as C
from tripstream.sinks.snapshot_table import SnapshotTable
from tripstream.sources.feed import FeedRules, _fmt, trip_messages
from tripstream.sources.tables import TableService, list_tables
from tripstream.streaming.counters import StreamCounters
from tripstream.streaming.ingest import message_file_stream, run_until_done, start_ingest

MULTI_OBJECT_RULES = FeedRules(split=False)
SPLIT_RULES = FeedRules(pack=False, split_mod=3, split_at=(20, 90, 200))


# ---- framing -------------------------------------------------------------
def q_decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    """non-null, non-blank messages per partition."""
    return (decode_messages(C.messages(spark, sf)).groupBy("partition")
            .agg(F.count(F.lit(1)).alias("messages")))


def _record_ids(spark, sf, rules) -> DataFrame:
    recs = frame_records(C.messages(spark, sf, rules))
    return parse_records(recs, now=C.fixed_now()).select("tripID", "partition", "offset")


def q_frame_multi_object(spark, sf):
    """several objects per message, junk between them."""
    return _record_ids(spark, sf, MULTI_OBJECT_RULES)


def q_frame_split_records(spark, sf):
    """objects cut over up to four messages."""
    return _record_ids(spark, sf, SPLIT_RULES)


def q_framing_counters(spark, sf):
    """F8: messages in, objects out."""
    msgs = C.messages(spark, sf)
    return framing_counters(msgs, frame_records(msgs))


# ---- parsing and dates ---------------------------------------------------
def q_parse_trips(spark, sf):
    """The 13 trip columns."""
    return C.trips(spark, sf)


def q_format_pickup(spark, sf):
    """T5: pickup time as ``yyyy-MM-dd HH:mm:ss`` text."""
    return C.trips(spark, sf).select("tripID", format_datetime("tpep_pickup_datetime").alias("pickup_text"))


def q_timestamps_formats(spark, sf):
    """Each of the four layouts reads back the same second."""
    ev = C.events(spark, sf)
    ts = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    return ev.select("event_id", F.pmod("event_id", F.lit(4)).cast("int").alias("layout"),
                     parse_strict(_fmt(ts, F.col("event_id"))).alias("parsed"))


def q_timestamps_lenient(spark, sf):
    """T4: out-of-range fields roll over."""
    ev = C.events(spark, sf)
    t = F.col("ts")
    text = F.format_string("%d-%d-%d %d:%d:%d", F.year(t), F.month(t) + 12, F.dayofmonth(t) + 31,
                           F.hour(t) + 24, F.minute(t) + 60, F.second(t))
    return ev.select("event_id", parse_lenient(text).alias("rolled"))


def q_timestamp_fallback(spark, sf):
    """Unreadable dates take the given clock."""
    recs = frame_records(C.messages(spark, sf, bad_dates=True))
    return good_rows(parse_records(recs, now=C.fixed_now())).select(
        "tripID", "tpep_pickup_datetime", "tpep_dropoff_datetime")


def q_epoch_to_ntz(spark, sf):
    """P5: epoch milliseconds back to a wall clock without zone."""
    ev = C.events(spark, sf)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return ev.select("event_id", ms.alias("epoch_ms"), epoch_millis_to_ntz(ms).alias("ts_ntz"))


# ---- validation ----------------------------------------------------------
def _faulty(spark, sf) -> DataFrame:
    return parse_records(frame_records(C.messages(spark, sf, faults=True)), now=C.fixed_now())


def q_reject_report(spark, sf):
    """V1-V6: rejects per reason."""
    return reject_report(_faulty(spark, sf))


def q_preview_truncate(spark, sf):
    """Log preview of whole documents."""
    docs = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet")
    return docs.select("doc_id", preview("text").alias("raw_preview"))


def q_mapper_counters(spark, sf):
    """A4."""
    return mapper_counters(_faulty(spark, sf))


def q_filter_counters(spark, sf):
    """A5."""
    return filter_counters(_faulty(spark, sf))


# ---- reports ---------------------------------------------------------------
def q_count_all(spark, sf):
    return reports.count_rows(C.trips(spark, sf))


def q_count_by_passenger(spark, sf):
    return reports.count_by_passenger(C.trips(spark, sf))


def q_filter_distance_text(spark, sf):
    return reports.where_text(C.trips(spark, sf), "trip_distance > '5.0'")


def q_filter_distance_number(spark, sf):
    return reports.distance_over(C.trips(spark, sf), 5.0)


def q_first_ten(spark, sf):
    return reports.first_rows(C.trips(spark, sf), 10, order_by="tripID")


# ---- snapshots and time travel -----------------------------------------
def _counts(df: DataFrame) -> DataFrame:
    return reports.count_by_passenger(df)


def q_min_snapshot(spark, sf):
    """A3: the smallest snapshot id, and the rows of the table as of it."""
    t = C.fixture_table(spark, sf)
    low = reports.min_snapshot(t.log())
    return low.crossJoin(reports.count_rows(t.as_of(snapshot_id=low.first()[0])))   # one row each


def q_earliest_snapshot(spark, sf):
    """Smallest id and first commit, and the rows of the table as of that."""
    t = C.fixture_table(spark, sf)
    first = reports.earliest_snapshot(t.log())
    return first.crossJoin(reports.count_rows(t.as_of(snapshot_id=first.first().earliest_id)))


def q_snapshot_list(spark, sf):
    return C.fixture_table(spark, sf).snapshots().orderBy("committed_at")


def q_history_list(spark, sf):
    """S7, with the rows that the table holds for each snapshot."""
    t = C.fixture_table(spark, sf)
    return t.history().join(t.rows_per_snapshot(), "snapshot_id").orderBy("made_current_at")


def q_as_of_id(spark, sf):
    return _counts(C.fixture_table(spark, sf).as_of(snapshot_id=C.snapshot_id_of(1)))


def q_as_of_timestamp(spark, sf):
    return _counts(C.fixture_table(spark, sf).as_of(timestamp=C.committed_at_of(0)))


def q_as_of_previous(spark, sf):
    return _counts(C.fixture_table(spark, sf).as_of())


def q_as_of_sql(spark, sf):
    view = f"json_data_v{C.snapshot_id_of(0)}"
    C.fixture_table(spark, sf).as_of(snapshot_id=C.snapshot_id_of(0)).createOrReplaceTempView(view)
    return spark.sql(f"SELECT passenger_count, COUNT(*) AS trip_count FROM {view} GROUP BY passenger_count")


def q_as_of_precedence(spark, sf):
    """An id wins over a timestamp."""
    t = C.fixture_table(spark, sf)
    return reports.count_rows(t.as_of(snapshot_id=C.snapshot_id_of(1), timestamp=C.committed_at_of(0)))


def q_as_of_fallback(spark, sf):
    """Unknown id and a one-snapshot table read the current rows."""
    t = C.fixture_table(spark, sf)
    unknown = reports.count_rows(t.as_of(snapshot_id=987654321, on_error="current"))
    one = SnapshotTable(spark, scratch_root(spark, "one"))
    one.append(C.trips(spark, sf), batch_id=0)
    single = reports.count_rows(one.as_of())
    return (unknown.select(F.lit("unknown_id").alias("scenario"), "row_count")
            .unionByName(single.select(F.lit("one_snapshot").alias("scenario"), "row_count")))


def q_append_idempotent(spark, sf):
    """K1, K2: a replayed batch id appends nothing."""
    t = SnapshotTable(spark, scratch_root(spark, "replay"))
    rows = C.trips(spark, sf)
    t.append(rows, batch_id=7)
    t.append(rows, batch_id=7)
    rows = reports.count_rows(t.current()).select(F.lit("rows").alias("item"), "row_count")
    commits = reports.count_rows(t.log()).select(F.lit("commits").alias("item"), "row_count")
    return rows.unionByName(commits)


def q_ensure_table_twice(spark, sf):
    """K3: created on the first call only."""
    t = SnapshotTable(spark, scratch_root(spark, "ensure"))
    first = t.ensure()
    n0 = t.current().count()
    t.append(C.trips(spark, sf), batch_id=0)
    second = t.ensure()
    cur = reports.count_rows(t.current())
    return (cur.select(F.lit(1).alias("attempt"), F.lit(first).alias("created"),
                       F.lit(n0).cast("long").alias("row_count"))
            .unionByName(cur.select(F.lit(2).alias("attempt"), F.lit(second).alias("created"), "row_count")))


def q_partition_days(spark, sf):
    """K4, K5: rows per pickup-day partition."""
    t = C.fixture_table(spark, sf)
    return reports.rows_per_day(t)


def q_table_fallback(spark, sf):
    """By path, by name (also after a later append), and empty when absent."""
    t = SnapshotTable(spark, scratch_root(spark, "named"))
    name = f"json_data_{uuid.uuid4().hex[:8]}"
    svc = TableService(spark, name, t.path)
    svc.register()
    rows = C.staged(C.trips(spark, sf), "named-rows")          # two appends read them
    t.append(rows.where("passenger_count = '1'"))
    early = svc.get_table().count()
    t.append(rows.where("passenger_count != '1'"))
    by_path = reports.count_rows(t.current()).select(F.lit("path").alias("method"), "row_count")
    by_name = reports.count_rows(svc.get_table()).select(F.lit("name").alias("method"), "row_count")
    before = by_name.select(F.lit("name_before").alias("method"), F.lit(early).cast("long").alias("row_count"))
    gone = TableService(spark, f"absent_{uuid.uuid4().hex[:8]}", scratch_root(spark, "absent"))
    absent = reports.count_rows(gone.get_table()).select(F.lit("absent").alias("method"), "row_count")
    return by_path.unionByName(by_name).unionByName(before).unionByName(absent)


def q_sql_fallback(spark, sf):
    """The same SQL, on the table bound under the missing name."""
    t = C.fixture_table(spark, sf)
    name = f"json_data_{uuid.uuid4().hex[:8]}"
    svc = TableService(spark, name, t.path)
    sql = "SELECT '{}' AS form, passenger_count, COUNT(*) AS trip_count FROM {} GROUP BY passenger_count"
    return (svc.execute_query(sql.format("plain", name))
            .unionByName(svc.execute_query(sql.format("qualified", f"default.q{name}")))
            .unionByName(svc.execute_query(sql.format("table", "{table}"))))


def q_list_tables(spark, sf):
    """K7, K8: tables of the namespace after registering the trip table."""
    t = C.fixture_table(spark, sf)
    TableService(spark, "default.json_data", t.path).register()
    return list_tables(spark, "default").where(F.col("tableName") == "json_data")


def q_describe_table(spark, sf):
    """Columns and partition fields, as they are, of the trip table and of the
    given tables ``events`` and ``documents``."""
    t = C.fixture_table(spark, sf)
    svc = TableService(spark, "default.json_data", t.path)
    svc.register()
    out = svc.describe().withColumn("table_name", F.lit("json_data"))
    for name in ("events", "documents"):
        known = f"{name}_{uuid.uuid4().hex[:8]}"
        spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet").createOrReplaceTempView(known)
        given = TableService(spark, known, scratch_root(spark, "given")).describe()
        out = out.unionByName(given.withColumn("table_name", F.lit(name)))
    return out


def q_time_travel_sql(spark, sf):
    """Plain SQL over table functions, by id, by time, and a range of pickup times."""
    C.fixture_table(spark, sf).register_functions("trips")
    ts = C.committed_at_of(1)
    return spark.sql(f"""
        SELECT 'id' AS form, passenger_count, COUNT(*) AS trip_count FROM trips_as_of({C.snapshot_id_of(1)}) GROUP BY ALL
        UNION ALL SELECT 'time', passenger_count, COUNT(*) FROM trips_at(TIMESTAMP_NTZ'{ts}') GROUP BY ALL
        UNION ALL SELECT 'range', passenger_count, COUNT(*)
        FROM trips_between(TIMESTAMP_NTZ'2024-01-05 06:00:00', TIMESTAMP_NTZ'2024-01-09 00:00:00') GROUP BY ALL""")


def q_pickup_predicate(spark, sf):
    """K4: a plain predicate on the pickup time; its day folders are found from it."""
    t = C.fixture_table(spark, sf)
    days = t.where("tpep_pickup_datetime >= '2024-01-20 12:00:00' AND tpep_pickup_datetime < '2024-01-22' "
                   "OR to_date(tpep_pickup_datetime) IN (DATE'2024-01-03', DATE'2024-01-07')")
    return (days.groupBy(F.to_date("tpep_pickup_datetime").alias("pickup_day")).agg(F.count(F.lit(1)).alias("trips")))


def q_sql_functions(spark, sf):
    """U1, U4, T1, T4, T5, P5, P7 as SQL functions."""
    sql_functions.register(spark)
    ev = C.events(spark, sf)
    ts = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    name = f"events_{uuid.uuid4().hex[:8]}"
    ev.select("event_id", F.concat(F.lit(" \t"), _fmt(ts, F.col("event_id")), F.lit("\u0001")).alias("text"),
              F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "props").createOrReplaceTempView(name)
    return spark.sql(f"""SELECT event_id, trip_date(java_trim(text)) AS parsed, trip_date_text(trip_date(java_trim(text))) AS shown,
        trip_date_lenient('2024-13-45 25:61:61') AS rolled, epoch_to_ntz(ms) AS ts_ntz,
        log_preview(repeat('x', CAST(200 + event_id % 3 AS INT))) AS preview FROM {name}""")


def q_nested_by_content(spark, sf):
    """Nested JSON compared by content (key order, blanks, number spelling), and a
    field of it by path."""
    trips = C.trips(spark, sf)
    user = json_field("primary_passenger", "$.user_id", "bigint")
    kind = json_field("primary_passenger", "$.event_type")
    other = F.concat(F.lit('{ "event_type" : "'), kind, F.lit('",  "user_id": '), user.cast("string"), F.lit(".00 }"))
    return trips.select("tripID", same_json("primary_passenger", other).alias("same"),
                        same_json("primary_passenger", "fare_details").alias("unlike"),
                        json_field("fare_details", "$.k", "bigint").alias("k"))


# ---- framing: strings, long records, SQL, state store ------------------------
def q_frame_string_aware(spark, sf):
    """braces, quotes and escapes inside strings, records cut anywhere, a stray
    quote outside of records."""
    recs = frame_records(C.quoted_messages(spark, sf), string_aware=True)
    return recs.select(F.get_json_object("record", "$.id").alias("id"), "partition", "offset", "pos",
                       F.length("record").alias("chars"))


def q_frame_partition_records(spark, sf):
    """one record over a whole Kafka partition (a stray ``{`` first, a ``}`` last), put
    together, and given out in pieces above a bound."""
    ev = C.events(spark, sf).select("event_id")
    part = (F.col("event_id") % 4).cast("int")
    body = ev.select(F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit("}")).alias("v"),
                     part.alias("partition"), (F.floor(F.col("event_id") / 4) + 1).cast("long").alias("offset"))
    ends = (body.groupBy("partition").agg(F.max("offset").alias("top"))
            .select("partition", F.explode(F.array(F.struct(F.lit("{").alias("v"), F.lit(0).cast("long").alias("offset")),
                                                   F.struct(F.lit("}").alias("v"), (F.col("top") + 1).alias("offset")))).alias("e")))
    msgs = (body.unionByName(ends.select("e.v", "partition", "e.offset"))
            .select(F.col("v").cast("binary").alias("value"), F.lit("t").alias("topic"), "partition", "offset"))
    whole = frame_records(msgs).groupBy("partition").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("record")).alias("chars"))
    pieces = frame_records(msgs, emit_long=True, max_record_chars=1000).groupBy("partition", "offset").agg(
        F.count("piece_offset").alias("rows"), F.sum(F.length("record")).alias("chars"))
    return (whole.select(F.lit("whole").alias("form"), "partition", "rows", "chars")
            .unionByName(pieces.select(F.lit("pieces").alias("form"), "partition", "rows", "chars")))


def q_frame_sql(spark, sf):
    """The decoder as a table function of SQL, a task for some segments."""
    sequential.register(spark)
    name = f"messages_{uuid.uuid4().hex[:8]}"
    msgs = C.messages(spark, sf, SPLIT_RULES).select("topic", "partition", "offset", "value")
    sequential.in_segments(msgs).createOrReplaceTempView(name)
    return spark.sql(f"""SELECT get_json_object(record, '$.tripID') AS tripID, partition, offset
        FROM frame_records(TABLE({name}) PARTITION BY (topic, partition, segment) ORDER BY offset)""")


def q_frame_state_store(spark, sf):
    """Open records in Spark's own state store, over two runs of one query."""
    root = scratch_root(spark, "state")
    msgs = C.messages(spark, sf, SPLIT_RULES).select("value", "topic", "partition", "offset", "key", "timestamp")
    msgs = C.staged(msgs, "state-feed")
    hi = msgs.agg(F.max("offset")).first()[0] or 0
    for part in (F.col("offset") <= hi // 2 + 1, F.col("offset") > hi // 2 + 1):
        stream = _stream_input(spark, msgs.where(part), f"{root}/in", 2)
        q = (sequential.frame_stream(stream).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
             .option("path", f"{root}/out").trigger(availableNow=True).start())
        run_until_done(q)
    return spark.read.schema(RECORD_SCHEMA).parquet(f"{root}/out").select(
        F.get_json_object("record", "$.tripID").alias("tripID"), "partition", "offset")


# ---- streaming -------------------------------------------------------------
def q_stream_ingest(spark, sf):
    """Messages as files -> stream (availableNow) -> table."""
    root = scratch_root(spark, "stream")
    msgs = C.staged(C.messages(spark, sf), "stream-feed")
    # three offset ranges written one after another, one file per Kafka
    # partition and range, rows in offset order: what a Kafka partition delivers
    hi = msgs.agg(F.max("offset")).first()[0] or 0
    cuts = [0, hi // 3 + 1, 2 * hi // 3 + 1, hi + 1]
    for lo, up in zip(cuts, cuts[1:]):
        (msgs.where((F.col("offset") >= lo) & (F.col("offset") < up))
         .repartition("topic", "partition").sortWithinPartitions("offset")
         .write.mode("append").parquet(f"{root}/in"))
        time.sleep(0.02)
    table = SnapshotTable(spark, f"{root}/table")
    q = start_ingest(message_file_stream(spark, f"{root}/in", max_files_per_trigger=4), table,
                     f"{root}/checkpoint", trigger={"availableNow": True}, now=C.fixed_now())
    run_until_done(q)
    return reports.rows_per_day(table)


def _stream_input(spark, messages: DataFrame, path: str, ranges: int = 3) -> DataFrame:
    """A stream over the messages, written as so many offset ranges, one file per Kafka
    partition and range at most, two files a micro-batch."""
    hi = messages.agg(F.max("offset")).first()[0] or 0
    cuts = [k * (hi // ranges + 1) for k in range(ranges + 1)]
    for lo, up in zip(cuts, cuts[1:]):
        (messages.where((F.col("offset") >= lo) & (F.col("offset") < up))
         .repartition("topic", "partition").sortWithinPartitions("offset")
         .write.mode("append").parquet(path))
        time.sleep(0.02)
    return message_file_stream(spark, path, max_files_per_trigger=2)


def _run(spark, messages: DataFrame, root: str, table: SnapshotTable, name: str, **kw) -> None:
    """One bounded stream over ``messages`` with a checkpoint of its own."""
    messages.repartition("topic", "partition").sortWithinPartitions("offset").write.parquet(f"{root}/{name}/in")
    run_until_done(start_ingest(message_file_stream(spark, f"{root}/{name}/in"), table, f"{root}/{name}/checkpoint",
                                trigger={"availableNow": True}, now=C.fixed_now(), **kw))


def q_two_streams_one_table(spark, sf):
    """K1, K2: two streams, each with batch ids from 0, append to one table."""
    root = scratch_root(spark, "two")
    table = SnapshotTable(spark, f"{root}/table")
    msgs = C.staged(C.messages(spark, sf, FeedRules(split=False, pack=False)), "two-feed")
    for part in (0, 1):
        _run(spark, msgs.where(F.col("partition") % 2 == part), root, table, f"stream{part}")
    commits = reports.count_rows(table.log()).select(F.lit("commits").alias("item"), "row_count")
    return commits.unionByName(reports.count_rows(table.current()).select(F.lit("rows").alias("item"), "row_count"))


def q_stream_counters(spark, sf):
    """F8, A4, A5 on the running stream: counters and rates over all micro-batches,
    collected by a query listener."""
    root = scratch_root(spark, "counters")
    counters = StreamCounters()
    stream = _stream_input(spark, C.staged(C.messages(spark, sf, faults=True), "counters-feed"), f"{root}/in")
    run_until_done(start_ingest(stream, SnapshotTable(spark, f"{root}/table"), f"{root}/checkpoint",
                                trigger={"availableNow": True}, now=C.fixed_now(), counters=counters))
    counters.detach()
    t = counters.totals()
    return spark.createDataFrame([tuple(t[k] for k in ("messages_in", "objects_out", "success", "failure", "success_pct", "null_pct"))],
                                 "messages_in long, objects_out long, success long, failure long, success_pct double, null_pct double")


def q_pickup_range(spark, sf):
    """K4: trips of some days; only those day folders are read."""
    t = C.fixture_table(spark, sf)
    return (t.between(_dt.datetime(2024, 1, 5, 6), _dt.datetime(2024, 1, 9))
            .groupBy(F.to_date("tpep_pickup_datetime").alias("pickup_day")).agg(F.count(F.lit(1)).alias("trips")))


def q_frame_long_records(spark, sf):
    """F4 without a length limit: a record over 1.2 million characters, whole or cut
    in three, between the ordinary messages of each Kafka partition."""
    plain = C.messages(spark, sf, FeedRules(split=False, pack=False))
    big = F.concat(F.lit('{"big":"'), F.repeat(F.lit("x"), 1_200_000), F.lit('"}'))
    last = plain.groupBy("topic", "partition").agg(F.max("offset").alias("top"))
    cut = F.when(F.col("partition") % 2 == 0, F.array(big)).otherwise(
        F.array(F.substring(big, 1, 400_000), F.substring(big, 400_001, 500_000), F.substring(big, 900_001, 500_000)))
    extra = (last.select("topic", "partition", "top", F.posexplode(cut).alias("i", "v"))
             .select(F.lit(None).cast("binary").alias("key"), F.col("v").cast("binary").alias("value"), "topic",
                     "partition", (F.col("top") + 1 + F.col("i")).alias("offset"),
                     F.lit(None).cast("timestamp").alias("timestamp")))
    recs = frame_records(plain.select(*extra.columns).unionByName(extra))
    return recs.groupBy("partition").agg(F.count(F.lit(1)).alias("records"),
                                         F.max(F.length("record")).cast("long").alias("longest"))


def q_malformed_bytes(spark, sf):
    """bytes that are not UTF-8 inside a record; the next ones are unharmed."""
    ev = C.events(spark, sf).select("event_id")
    value = F.concat(F.lit('{"a":"').cast("binary"), F.unhex(F.lit("E0")), F.lit('}{"b":1}{"c":').cast("binary"))
    rows = ev.select(value.alias("value"), F.lit("t").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
                     (2 * F.col("event_id")).cast("long").alias("offset"))
    tail = ev.select(F.concat(F.col("event_id").cast("string"), F.lit('}{"d":4}')).cast("binary").alias("value"),
                     F.lit("t").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
                     (2 * F.col("event_id") + 1).cast("long").alias("offset"))
    recs = frame_records(rows.unionByName(tail))
    return recs.groupBy(F.when(F.col("record").startswith('{"c"'), '{"c"').otherwise(F.col("record")).alias("record")
                        ).agg(F.count(F.lit(1)).alias("records"))


QUERIES = {
    "decode_messages": q_decode_messages,
    "frame_multi_object": q_frame_multi_object,
    "frame_split_records": q_frame_split_records,
    "framing_counters": q_framing_counters,
    "parse_trips": q_parse_trips,
    "format_pickup": q_format_pickup,
    "timestamps_formats": q_timestamps_formats,
    "timestamps_lenient": q_timestamps_lenient,
    "timestamp_fallback": q_timestamp_fallback,
    "epoch_to_ntz": q_epoch_to_ntz,
    "reject_report": q_reject_report,
    "preview_truncate": q_preview_truncate,
    "mapper_counters": q_mapper_counters,
    "filter_counters": q_filter_counters,
    "count_all": q_count_all,
    "count_by_passenger": q_count_by_passenger,
    "filter_distance_text": q_filter_distance_text,
    "filter_distance_number": q_filter_distance_number,
    "first_ten": q_first_ten,
    "min_snapshot": q_min_snapshot,
    "earliest_snapshot": q_earliest_snapshot,
    "snapshot_list": q_snapshot_list,
    "history_list": q_history_list,
    "as_of_id": q_as_of_id,
    "as_of_timestamp": q_as_of_timestamp,
    "as_of_previous": q_as_of_previous,
    "as_of_sql": q_as_of_sql,
    "as_of_precedence": q_as_of_precedence,
    "as_of_fallback": q_as_of_fallback,
    "append_idempotent": q_append_idempotent,
    "ensure_table_twice": q_ensure_table_twice,
    "partition_days": q_partition_days,
    "table_fallback": q_table_fallback,
    "sql_fallback": q_sql_fallback,
    "list_tables": q_list_tables,
    "describe_table": q_describe_table,
    "stream_ingest": q_stream_ingest,
    "two_streams_one_table": q_two_streams_one_table,
    "stream_counters": q_stream_counters,
    "pickup_range": q_pickup_range,
    "frame_long_records": q_frame_long_records,
    "malformed_bytes": q_malformed_bytes,
    "time_travel_sql": q_time_travel_sql,
    "pickup_predicate": q_pickup_predicate,
    "sql_functions": q_sql_functions,
    "nested_by_content": q_nested_by_content,
    "frame_string_aware": q_frame_string_aware,
    "frame_partition_records": q_frame_partition_records,
    "frame_sql": q_frame_sql,
    "frame_state_store": q_frame_state_store,
}
