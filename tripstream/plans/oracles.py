"""DuckDB SQL computing each registered query's expected rows from ``events``
(and ``documents``), following the fixture rules of FIXTURES.md.
"""

from __future__ import annotations

from tripstream.plans.common import FIXED_NOW, SNAPSHOT_IDS
from tripstream.plans.queries import MULTI_OBJECT_RULES, SPLIT_RULES
from tripstream.sources.feed import FeedRules

R = FeedRules()
NOW = f"TIMESTAMP '{FIXED_NOW:%Y-%m-%d %H:%M:%S}'"

TRIP_COLS = ", ".join([
    "tripID", "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "primary_passenger", "fare_details"])

TRIPS = """trips AS (
  SELECT 'e' || event_id AS tripID,
         CAST(user_id % 2 + 1 AS VARCHAR) AS VendorID,
         date_trunc('second', ts) AS tpep_pickup_datetime,
         date_trunc('second', ts) + INTERVAL 10 MINUTE AS tpep_dropoff_datetime,
         CAST(event_id % 6 + 1 AS VARCHAR) AS passenger_count,
         CAST(value AS VARCHAR) AS trip_distance,
         CAST(event_id % 5 + 1 AS VARCHAR) AS RatecodeID,
         CASE WHEN event_id % 10 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(user_id AS VARCHAR) AS PULocationID,
         CAST(event_id % 265 AS VARCHAR) AS DOLocationID,
         event_type AS payment_type,
         '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS primary_passenger,
         replace(props, ' ', '') AS fare_details,
         CAST(floor((day(ts) - 1) / 10) AS INTEGER) AS batch,
         event_id
  FROM events)"""

_SID = "CASE b " + " ".join(f"WHEN {k} THEN {v}" for k, v in SNAPSHOT_IDS.items()) + " ELSE 1000 + b END"
SNAPS = f"""snaps AS (
  SELECT b, CAST({_SID} AS BIGINT) AS sid,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(10 * (b + 1) AS INTEGER)) AS cat,
         added
  FROM (SELECT batch AS b, COUNT(*) AS added FROM trips GROUP BY batch))"""


def _packed(r: FeedRules) -> str:
    return f"(event_id % {r.pack_mod} = {r.pack_rem})" if r.pack else "FALSE"


def _split(r: FeedRules) -> str:
    return f"(event_id % {r.split_mod} = 0 AND NOT {_packed(r)})" if r.split else "FALSE"


def _message_counts(r: FeedRules, blanks: bool) -> str:
    """Messages per partition made by the feed (nulls never, blanks optionally)."""
    n_cuts = len(r.split_at)
    blank = f" + CASE WHEN event_id % {r.tombstone_mod} = {r.blank_rem} THEN 1 ELSE 0 END" if blanks else ""
    return f"""per_event AS (
  SELECT CAST(event_id % {r.partitions} AS INTEGER) AS partition,
         CASE WHEN {_packed(r)} THEN 0 ELSE 1 END
         + CASE WHEN {_split(r)} THEN {n_cuts} ELSE 0 END
         + CASE WHEN event_id % {r.stray_mod} = {r.stray_rem} THEN 1 ELSE 0 END{blank} AS n
  FROM events),
packs AS (
  SELECT CAST(event_id % {r.partitions} AS INTEGER) AS partition, COUNT(DISTINCT event_id // {r.pack_span}) AS n
  FROM events WHERE {_packed(r)} GROUP BY 1),
msgs AS (SELECT partition, n FROM per_event UNION ALL SELECT partition, n FROM packs)"""


def _record_offsets(r: FeedRules) -> str:
    slot = f"8 * (event_id // {r.partitions})"
    if r.pack:
        off = (f"CASE WHEN {_packed(r)} THEN MIN({slot}) OVER (PARTITION BY event_id % {r.partitions}, "
               f"event_id // {r.pack_span}, {_packed(r)}) ELSE {slot} END")
    else:
        off = slot
    return (f"SELECT 'e' || event_id AS tripID, CAST(event_id % {r.partitions} AS INTEGER) AS partition, "
            f"CAST({off} AS BIGINT) AS offset FROM events")


_BAD = (f"CASE WHEN event_id % {R.bad_json_mod} = 0 THEN 'bad_json' "
        f"WHEN event_id % {R.empty_id_mod} = 0 THEN 'missing_trip_id' "
        f"WHEN event_id % {R.missing_key_mod} = 0 THEN 'missing_field' END")


def _counts_upto(batch: int) -> str:
    return (f"WITH {TRIPS} SELECT passenger_count, COUNT(*) AS trip_count FROM trips "
            f"WHERE batch <= {batch} GROUP BY passenger_count")


ORACLES: dict[str, str] = {
    "decode_messages": f"WITH {_message_counts(R, blanks=False)} "
                       "SELECT partition, CAST(SUM(n) AS BIGINT) AS messages FROM msgs GROUP BY partition",
    "frame_multi_object": _record_offsets(MULTI_OBJECT_RULES),
    "frame_split_records": _record_offsets(SPLIT_RULES),
    "framing_counters": f"WITH {_message_counts(R, blanks=True)} "
                        "SELECT CAST(SUM(n) AS BIGINT) AS messages_in, "
                        "(SELECT COUNT(*) FROM events) AS objects_out FROM msgs",
    "parse_trips": f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips",
    "format_pickup": f"WITH {TRIPS} SELECT tripID, strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') "
                     "AS pickup_text FROM trips",
    "timestamps_formats": "SELECT event_id, CAST(event_id % 4 AS INTEGER) AS layout, "
                          "date_trunc('second', ts) AS parsed FROM events",
    "timestamps_lenient": "SELECT event_id, date_trunc('month', ts) + INTERVAL 12 MONTH "
                          "+ to_days(CAST(day(ts) + 30 AS INTEGER)) + to_hours(CAST(hour(ts) + 24 AS BIGINT)) "
                          "+ to_minutes(CAST(minute(ts) + 60 AS BIGINT)) + to_seconds(CAST(second(ts) AS BIGINT)) "
                          "AS rolled FROM events",
    "timestamp_fallback": f"SELECT 'e' || event_id AS tripID, "
                          f"CASE WHEN event_id % {R.bad_date_mod} = 0 THEN {NOW} ELSE date_trunc('second', ts) END "
                          f"AS tpep_pickup_datetime, "
                          f"CASE WHEN event_id % {R.bad_date_mod} = 0 THEN {NOW} "
                          f"ELSE date_trunc('second', ts) + INTERVAL 10 MINUTE END AS tpep_dropoff_datetime FROM events",
    "epoch_to_ntz": "SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, date_trunc('millisecond', ts) AS ts_ntz FROM events",
    "reject_report": f"SELECT reason, COUNT(*) AS rejects FROM (SELECT {_BAD} AS reason FROM events) "
                     "WHERE reason IS NOT NULL GROUP BY reason",
    "preview_truncate": "SELECT doc_id, CASE WHEN text IS NULL THEN 'null' WHEN length(text) <= 200 THEN text "
                        "ELSE substring(text, 1, 200) || '... (' || CAST(length(text) - 200 AS VARCHAR) "
                        "|| ' more bytes)' END AS raw_preview FROM documents",
    "mapper_counters": f"WITH r AS (SELECT CASE WHEN ({_BAD}) IS NULL THEN 0 ELSE 1 END AS bad FROM events) "
                       "SELECT COUNT(*) AS total, CAST(COUNT(*) - SUM(bad) AS BIGINT) AS success, "
                       "CAST(SUM(bad) AS BIGINT) AS failure, CASE WHEN COUNT(*) > 0 THEN "
                       "round(CAST((COUNT(*) - SUM(bad)) * 100.0 AS DOUBLE) / COUNT(*), 1) ELSE 0.0 END "
                       "AS success_pct FROM r",
    "filter_counters": f"WITH r AS (SELECT CASE WHEN ({_BAD}) IS NULL THEN 0 ELSE 1 END AS bad FROM events) "
                       "SELECT COUNT(*) AS total, CAST(SUM(bad) AS BIGINT) AS nulls, CASE WHEN COUNT(*) > 0 THEN "
                       "round(CAST(SUM(bad) * 100.0 AS DOUBLE) / COUNT(*), 2) ELSE 0.0 END AS null_pct FROM r",
    "count_all": "SELECT COUNT(*) AS row_count FROM events",
    "count_by_passenger": f"WITH {TRIPS} SELECT passenger_count, COUNT(*) AS trip_count FROM trips "
                          "GROUP BY passenger_count ORDER BY trip_count DESC, passenger_count",
    "filter_distance_text": f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips WHERE trip_distance > '5.0'",
    "filter_distance_number": f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips "
                              "WHERE TRY_CAST(trip_distance AS DOUBLE) > 5.0",
    "first_ten": f"WITH {TRIPS} SELECT {TRIP_COLS} FROM trips ORDER BY tripID LIMIT 10",
    "min_snapshot": f"WITH {TRIPS}, {SNAPS} SELECT MIN(sid) AS min_id, (SELECT COUNT(*) FROM trips "
                    "WHERE batch <= (SELECT arg_min(b, sid) FROM snaps)) AS row_count FROM snaps",
    "earliest_snapshot": f"WITH {TRIPS}, {SNAPS} SELECT MIN(sid) AS min_id, arg_min(sid, cat) AS earliest_id, "
                         "arg_min(added, cat) AS row_count FROM snaps",
    "snapshot_list": f"WITH {TRIPS}, {SNAPS} SELECT cat AS committed_at, sid AS snapshot_id, "
                     "LAG(sid) OVER (ORDER BY b) AS parent_id, 'append' AS operation, added AS added_rows "
                     "FROM snaps ORDER BY cat",
    "history_list": f"WITH {TRIPS}, {SNAPS} SELECT cat AS made_current_at, sid AS snapshot_id, "
                    "LAG(sid) OVER (ORDER BY b) AS parent_id, TRUE AS is_current_ancestor, added AS row_count "
                    "FROM snaps ORDER BY cat",
    "as_of_id": _counts_upto(1),
    "as_of_timestamp": _counts_upto(0),
    "as_of_previous": f"WITH {TRIPS} SELECT passenger_count, COUNT(*) AS trip_count FROM trips "
                      "WHERE batch < (SELECT MAX(batch) FROM trips) OR (SELECT COUNT(DISTINCT batch) FROM trips) < 2 "
                      "GROUP BY passenger_count",
    "as_of_sql": _counts_upto(0),
    "as_of_precedence": f"WITH {TRIPS} SELECT COUNT(*) AS row_count FROM trips WHERE batch <= 1",
    "as_of_fallback": "SELECT 'unknown_id' AS scenario, COUNT(*) AS row_count FROM events "
                      "UNION ALL SELECT 'one_snapshot', COUNT(*) FROM events",
    "append_idempotent": "SELECT 'rows' AS item, COUNT(*) AS row_count FROM events "
                         "UNION ALL SELECT 'commits', CAST(1 AS BIGINT)",
    "ensure_table_twice": "SELECT 1 AS attempt, TRUE AS created, CAST(0 AS BIGINT) AS row_count "
                          "UNION ALL SELECT 2, FALSE, COUNT(*) FROM events",
    "partition_days": "SELECT CAST(ts AS DATE) AS pickup_day, COUNT(*) AS trips FROM events GROUP BY 1",
    "table_fallback": "SELECT 'path' AS method, COUNT(*) AS row_count FROM events "
                      "UNION ALL SELECT 'name', COUNT(*) FROM events "
                      "UNION ALL SELECT 'name_before', COUNT(*) FROM events WHERE event_id % 6 = 0 "
                      "UNION ALL SELECT 'absent', CAST(0 AS BIGINT)",
    "sql_fallback": f"WITH {TRIPS} SELECT form, passenger_count, COUNT(*) AS trip_count FROM trips, "
                    "(VALUES ('plain'), ('qualified'), ('table')) AS f(form) GROUP BY form, passenger_count",
    "list_tables": "SELECT 'default' AS namespace, 'json_data' AS tableName, FALSE AS isTemporary",
    "describe_table": "SELECT * FROM (VALUES " + ", ".join(
        [f"('json_data', '{c.strip()}', '{'timestamp_ntz' if 'datetime' in c else 'string'}', FALSE)" for c in TRIP_COLS.split(",")]
        + ["('json_data', 'snapshot_seq', 'int', TRUE)", "('json_data', 'pickup_day', 'date', TRUE)"])
        + ") AS t(table_name, col_name, data_type, partition_key) UNION ALL "
        + " UNION ALL ".join(
            f"SELECT '{t}', column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
            f"WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
            f"WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' END, FALSE FROM (DESCRIBE SELECT * FROM {t})"
            for t in ("events", "documents")),
    "two_streams_one_table": "SELECT 'commits' AS item, CAST(2 AS BIGINT) AS row_count "
                             "UNION ALL SELECT 'rows', COUNT(*) FROM events",
    "stream_counters": f"WITH {_message_counts(R, blanks=True)}, r AS (SELECT CASE WHEN ({_BAD}) IS NULL THEN 0 ELSE 1 END AS bad "
                       "FROM events) SELECT (SELECT CAST(SUM(n) AS BIGINT) FROM msgs) AS messages_in, COUNT(*) AS objects_out, "
                       "CAST(COUNT(*) - SUM(bad) AS BIGINT) AS success, CAST(SUM(bad) AS BIGINT) AS failure, "
                       "round(CAST((COUNT(*) - SUM(bad)) * 100.0 AS DOUBLE) / COUNT(*), 1) AS success_pct, "
                       "round(CAST(SUM(bad) * 100.0 AS DOUBLE) / COUNT(*), 2) AS null_pct FROM r",
    "time_travel_sql": f"WITH {TRIPS} SELECT form, passenger_count, COUNT(*) AS trip_count FROM trips, "
                       "(VALUES ('id'), ('time'), ('range')) AS f(form) WHERE CASE form WHEN 'range' THEN "
                       "tpep_pickup_datetime >= TIMESTAMP '2024-01-05 06:00:00' AND tpep_pickup_datetime < TIMESTAMP '2024-01-09' "
                       "ELSE batch <= 1 END GROUP BY form, passenger_count",
    "pickup_predicate": "SELECT CAST(ts AS DATE) AS pickup_day, COUNT(*) AS trips FROM events "
                        "WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-20 12:00:00' "
                        "AND date_trunc('second', ts) < TIMESTAMP '2024-01-22' "
                        "OR CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-07') GROUP BY 1",
    "sql_functions": "SELECT event_id, date_trunc('second', ts) AS parsed, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, "
                     "TIMESTAMP '2025-02-15 02:02:01' AS rolled, date_trunc('millisecond', ts) AS ts_ntz, "
                     "CASE event_id % 3 WHEN 0 THEN repeat('x', 200) ELSE repeat('x', 200) || '... (' || (event_id % 3) || ' more bytes)' "
                     "END AS preview FROM events",
    "nested_by_content": f"WITH {TRIPS} SELECT tripID, TRUE AS same, FALSE AS unlike, "
                         "CAST(json_extract(fare_details, '$.k') AS BIGINT) AS k FROM trips",
    "frame_string_aware": "SELECT 'e' || event_id AS id, CAST(event_id % 4 AS INTEGER) AS partition, "
                          "CAST(2 * (event_id // 4) + CASE WHEN event_id % 7 = 0 AND event_id % 40 = 0 THEN 1 ELSE 0 END AS BIGINT) "
                          "AS offset, 0 AS pos, CAST(length('{\"id\":\"e' || event_id || '\",\"note\":\"}{\\\"' || event_type "
                          "|| '\\\\\",\"n\":{\"k}\":\"{\"}}') AS INTEGER) AS chars FROM events",
    "frame_partition_records": "WITH p AS (SELECT CAST(event_id % 4 AS INTEGER) AS partition, COUNT(*) AS n, "
                               "CAST(SUM(length('{\"id\":' || event_id || '}')) + 2 AS BIGINT) AS chars FROM events GROUP BY 1) "
                               "SELECT 'whole' AS form, partition, CAST(1 AS BIGINT) AS rows, chars FROM p "
                               "UNION ALL SELECT 'pieces', partition, n + 2, chars FROM p",
    "frame_sql": _record_offsets(SPLIT_RULES),
    "frame_state_store": _record_offsets(SPLIT_RULES),
    "pickup_range": "SELECT CAST(ts AS DATE) AS pickup_day, COUNT(*) AS trips FROM events "
                    "WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-05 06:00:00' "
                    "AND date_trunc('second', ts) < TIMESTAMP '2024-01-09 00:00:00' GROUP BY 1",
    "frame_long_records": "SELECT CAST(event_id % 4 AS INTEGER) AS partition, COUNT(*) + 1 AS records, "
                          "CAST(1200010 AS BIGINT) AS longest FROM events GROUP BY 1",
    "malformed_bytes": "SELECT r AS record, COUNT(*) AS records FROM events, (VALUES ('{\"a\":\"\ufffd}'), ('{\"b\":1}'), "
                       "('{\"c\"'), ('{\"d\":4}')) AS t(r) GROUP BY r",
    "stream_ingest": "SELECT CAST(ts AS DATE) AS pickup_day, COUNT(*) AS trips FROM events GROUP BY 1",
}
