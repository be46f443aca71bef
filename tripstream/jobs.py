"""Job entry points: the streaming ingest job and the query report.

    python -m tripstream.jobs ingest --source kafka --table PATH --checkpoint PATH
    python -m tripstream.jobs ingest --source files --input PATH --table PATH --checkpoint PATH --available-now
    python -m tripstream.jobs report --table PATH [--name default.json_data]

Without ``--table`` the table lies at warehouse/namespace/name.
"""

from __future__ import annotations

import argparse
from collections import OrderedDict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripstream.config import JobOptions, build_session
from tripstream.operators import reports
from tripstream.sinks.snapshot_table import SnapshotNotFound, SnapshotTable
from tripstream.sources.tables import TableService, list_namespaces, list_tables
from tripstream.streaming.counters import StreamCounters
from tripstream.streaming.ingest import kafka_stream, message_file_stream, run_until_done, start_ingest


def query_report(spark: SparkSession, table: SnapshotTable, name: str = "default.json_data",
                 limit: int = 10) -> "OrderedDict[str, DataFrame]":
    """The query app's sequence, as named DataFrames (nothing is collected here).

    Catalog listing, first rows, count, trips per passenger count, the text
    filter, snapshots in time order, the table as of the earliest snapshot
    id (falling back to the current rows when that fails), history, snapshots.
    """
    svc = TableService(spark, name, table.path)
    svc.register()
    cur = svc.get_table()
    out: "OrderedDict[str, DataFrame]" = OrderedDict()
    out["namespaces"] = list_namespaces(spark)
    out["tables"] = list_tables(spark, name.rsplit(".", 1)[0] if "." in name else "default")
    out["first_rows"] = reports.first_rows(cur, limit)
    out["count"] = reports.count_rows(cur)
    out["trips_per_passenger_count"] = reports.count_by_passenger(cur)
    out["distance_over_5_text"] = reports.first_rows(reports.where_text(cur, "trip_distance > '5.0'"), limit)
    out["snapshots_by_time"] = table.log().select("snapshot_id", "committed_at").orderBy("committed_at")
    min_id = table.log().agg(F.min("snapshot_id")).first()[0]   # one row
    try:
        if min_id is None:
            raise SnapshotNotFound("no snapshot yet")
        out["as_of_min_snapshot"] = reports.first_rows(table.as_of(snapshot_id=min_id), limit)
    except (SnapshotNotFound, AnalysisException):
        out["as_of_min_snapshot"] = reports.first_rows(cur, limit)
    out["history"] = table.history()
    out["snapshots"] = table.snapshots()
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tripstream.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--source", choices=["kafka", "files"], default="kafka")
    ing.add_argument("--input", help="folder of Parquet files with Kafka's columns (files source)")
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--available-now", action="store_true")
    ing.add_argument("--max-offsets-per-trigger", type=int, default=5_000_000,
                     help="messages a Kafka micro-batch at most")
    rep = sub.add_parser("report")
    for p in (ing, rep):
        p.add_argument("--parallelism", type=int, help="shuffle partitions (default: the cluster's setting)")
        p.add_argument("--table", help="path of the table (default: warehouse/namespace/table name)")
        for field in ("warehouse", "table_namespace", "table_name"):
            p.add_argument(f"--{field.replace('_', '-')}", default=getattr(JobOptions, field))
    rep.add_argument("--name", help="catalog name (default: namespace.table name)")
    args = ap.parse_args(argv)

    opts = JobOptions(warehouse=args.warehouse, table_namespace=args.table_namespace, table_name=args.table_name)
    spark = build_session(shuffle_partitions=args.parallelism)
    table = SnapshotTable(spark, args.table or opts.table_path)
    if args.cmd == "ingest":
        src = (kafka_stream(spark, args.max_offsets_per_trigger, opts) if args.source == "kafka"
               else message_file_stream(spark, args.input))
        trigger = {"availableNow": True} if args.available_now else {"processingTime": opts.trigger_interval}
        counters = StreamCounters()
        q = start_ingest(src, table, args.checkpoint, trigger=trigger, counters=counters)
        run_until_done(q)
        print(counters.totals())
    else:
        for title, df in query_report(spark, table, args.name or f"{opts.table_namespace}.{opts.table_name}").items():
            print(f"== {title}")
            df.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
