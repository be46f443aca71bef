"""Driver contract: entry runs; each query with an oracle matches DuckDB at sf0.001."""

import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
FAST = ["decode_messages", "frame_split_records", "parse_trips", "timestamps_formats", "timestamps_lenient",
        "epoch_to_ntz", "reject_report", "preview_truncate", "count_by_passenger", "filter_distance_text",
        "snapshot_list", "as_of_id", "as_of_previous", "partition_days", "table_fallback", "frame_string_aware", "frame_partition_records", "frame_sql", "time_travel_sql",
        "pickup_predicate", "sql_functions", "nested_by_content", "stream_counters", "describe_table"]


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["passenger_count", "trip_count"]
    assert sum(r.trip_count for r in df.collect()) == 1000


def test_every_core_query_has_an_oracle():
    """Queries of the optional parts are checked beside them, in ``tests/llm``."""
    from tripstream.plans.oracles import ORACLES
    from tripstream.plans.queries import QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[name](spark, SF)
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, res.fetchall())
