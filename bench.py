"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians, s),
"unit", "queries": {name: median s}, "rates": {...}, "sf", "cpus", ...}.

Input: Kafka-shaped messages derived by Spark from ``events`` and written
once to Parquet (the topic at rest); every timed query starts from there.
Each query: one warm-up run, then the median of three timed runs
(stream ingest: one timed run, it is stateful).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripstream.config import build_session, scratch_root  # noqa: E402
from tripstream.operators import reports  # noqa: E402
from tripstream.operators.framing import frame_records  # noqa: E402
from tripstream.operators.parse import parse_records  # noqa: E402
from tripstream.operators.quality import good_rows  # noqa: E402
from tripstream.plans.common import fixed_now  # noqa: E402
from tripstream.sinks.snapshot_table import SnapshotTable  # noqa: E402
from tripstream.sources.feed import trip_messages  # noqa: E402
from tripstream.sources.tables import TableService  # noqa: E402
from tripstream.streaming.ingest import message_file_stream, run_until_done, start_ingest  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, runs: int = 3, warm: int = 1) -> float:
    for _ in range(warm):
        fn()
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="tripstream-bench")
    root = scratch_root(spark, "bench")

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # the topic at rest: one file per Kafka partition and offset range, in offset order
    hi = events.agg(F.max("event_id")).first()[0] or 0
    feed = trip_messages(events)
    top = 2 * (hi + 1) + 8
    cuts = [0, top // 3, 2 * top // 3, top + 1]
    for lo, up in zip(cuts, cuts[1:]):
        (feed.where((F.col("offset") >= lo) & (F.col("offset") < up))
         .repartition("topic", "partition").sortWithinPartitions("offset")
         .write.mode("append").parquet(f"{root}/messages"))
        time.sleep(0.02)
    msgs = spark.read.parquet(f"{root}/messages")
    n_msgs = msgs.count()
    n_events = events.count()

    def checked():
        return parse_records(frame_records(msgs), now=fixed_now())

    # a table with the trips as three snapshots, for the read queries
    table = SnapshotTable(spark, f"{root}/table")
    rows = checked().withColumn("_b", F.floor((F.dayofmonth("tpep_pickup_datetime") - 1) / 10))
    for b in (0, 1, 2):
        table.append_checked(rows.where(F.col("_b") == b).drop("_b"), batch_id=b)
    svc = TableService(spark, "bench_json_data", table.path)
    svc.register()
    first_id = table.log().orderBy("snapshot_seq").first().snapshot_id

    q: dict[str, float] = {}
    q["frame_hybrid"] = _timed(lambda: _noop(frame_records(msgs)))
    q["frame_tokens_only"] = _timed(lambda: _noop(frame_records(msgs, regex_fast_path=False)))
    # one record that never closes, opened by the first message of Kafka
    # partition 0 (a quarter of the topic): forced segment starts spread it
    first0 = msgs.where(F.col("partition") == 0).agg(F.min("offset")).first()[0]
    opened = msgs.withColumn("value", F.when(
        (F.col("partition") == 0) & (F.col("offset") == F.lit(first0)),
        F.concat(F.lit('{"open":' + "{" * 1000).cast("binary"), F.col("value"))).otherwise(F.col("value")))
    q["frame_open_record"] = _timed(lambda: _noop(frame_records(opened)))
    q["parse_validate"] = _timed(lambda: _noop(checked()))
    q["count_by_passenger_ingest"] = _timed(
        lambda: reports.count_by_passenger(good_rows(checked())).collect())

    def append_once():
        t = SnapshotTable(spark, scratch_root(spark, "bench-append"))
        t.append_checked(checked(), batch_id=0)

    q["append_snapshot"] = _timed(append_once)
    q["count_all_table"] = _timed(lambda: spark.sql("SELECT COUNT(*) FROM bench_json_data").collect())
    q["count_by_passenger_table"] = _timed(lambda: spark.sql(
        "SELECT passenger_count, COUNT(*) AS trip_count FROM bench_json_data "
        "GROUP BY passenger_count ORDER BY trip_count DESC").collect())
    q["filter_text_table"] = _timed(lambda: _noop(spark.sql(
        "SELECT * FROM bench_json_data WHERE trip_distance > '5.0'")))
    q["read_as_of_snapshot"] = _timed(
        lambda: reports.count_by_passenger(table.as_of(snapshot_id=first_id)).collect())

    def stream_once():
        r = scratch_root(spark, "bench-stream")
        t = SnapshotTable(spark, f"{r}/table")
        query = start_ingest(message_file_stream(spark, f"{root}/messages"), t,
                             f"{r}/checkpoint", trigger={"availableNow": True}, now=fixed_now())
        run_until_done(query)

    q["stream_ingest_available_now"] = _timed(stream_once, runs=1, warm=1)

    rates = {
        "frame_hybrid_msgs_per_s": round(n_msgs / q["frame_hybrid"]),
        "frame_tokens_only_msgs_per_s": round(n_msgs / q["frame_tokens_only"]),
        "parse_validate_rows_per_s": round(n_events / q["parse_validate"]),
        "stream_ingest_rows_per_s": round(n_events / q["stream_ingest_available_now"]),
    }
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "rates": rates,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "messages": n_msgs,
        "events": n_events,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
