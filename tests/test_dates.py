"""Date table and epoch conversion."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripstream.functions.dates import epoch_millis_to_ntz, format_datetime, parse_datetime, parse_lenient, parse_strict

D = dt.datetime
NOW = D(2000, 1, 1)

STRICT = [
    ("2024-01-15 10:00:00", D(2024, 1, 15, 10)),
    ("2024/01/15 10:00:00", D(2024, 1, 15, 10)),
    ("01/15/2024 10:00:00", D(2024, 1, 15, 10)),
    ("15-01-2024 10:00:00", D(2024, 1, 15, 10)),
    ("2024-02-30 00:00:00", None),
    ("2024-01-15 10:00:00.123", D(2024, 1, 15, 10)),
    ("2024-1-5 1:2:3", D(2024, 1, 5, 1, 2, 3)),
    ("24-01-15 10:00:00", None),
    ("2024-01-15T10:00:00", None),
    ("2024-01-15", None),
    ("", None),
    (None, None),
]

LENIENT = [
    ("2024-13-45 25:61:61", D(2025, 2, 15, 2, 2, 1)),
    ("2024-02-30 00:00:00", D(2024, 3, 1)),
    ("2024-01-15 10:00:00 trailing", D(2024, 1, 15, 10)),
    ("2024-01-15", None),
]


@pytest.mark.parametrize("table,fn", [(STRICT, parse_strict), (LENIENT, parse_lenient)])
def test_date_tables(spark, table, fn):
    df = spark.createDataFrame(table, "s string, want timestamp_ntz")
    for r in df.select("want", fn("s").alias("got")).collect():
        assert r.got == r.want


def test_fallback_and_format(spark):
    df = spark.createDataFrame([("bad",), (None,), ("2024/1/2 3:4:5",)], "s string")
    got = [r[0] for r in df.select(parse_datetime("s", now=F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))).collect()]
    assert got == [NOW, NOW, D(2024, 1, 2, 3, 4, 5)]
    txt = df.select(format_datetime(parse_datetime("s", now=F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))).collect()
    assert txt[2][0] == "2024-01-02 03:04:05"


def test_epoch_millis_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        v = spark.range(1).select(epoch_millis_to_ntz(F.lit(1705312800123)).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == D(2024, 1, 15, 10, 0, 0, 123000)
