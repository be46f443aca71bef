"""JSON edge table, reject reasons, required columns."""

import datetime as dt

from pyspark.sql import functions as F

from tripstream.functions.text import preview
from tripstream.operators.parse import parse_records
from tripstream.operators.quality import filter_counters, good_rows, mapper_counters, reject_rows



def now():
    return F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")

FULL = ('"VendorID":"1","tpep_pickup_datetime":"2024-01-15 10:00:00","tpep_dropoff_datetime":"2024-01-15 10:10:00",'
        '"passenger_count":"2","trip_distance":"3.5","RatecodeID":"1","store_and_fwd_flag":"N",'
        '"PULocationID":"10","DOLocationID":"20","payment_type":"card",'
        '"primary_passenger":{ "user_id" : 7 , "w": 1.50},"fare_details":{"k":1}')


def rec(body):
    return "{" + body + "}"


CASES = [
    (rec('"tripID":"t1",' + FULL), None),
    ('{"tripID":}', "bad_json"),
    ("{'tripID':'x'," + FULL + "}", "bad_json"),
    ('[{"tripID":"a"}]', "bad_shape"),
    ('{"tripID":"t3"} trailing', "bad_shape"),
    ("   ", "bad_shape"),
    (rec('"tripID":"",' + FULL), "missing_trip_id"),
    (rec(FULL), "missing_trip_id"),
    (rec('"tripID":"t4",' + FULL.replace('"VendorID":"1",', "")), "missing_field"),
    (rec('"tripID":"t5",' + FULL.replace('"VendorID":"1"', '"VendorID":null')), "missing_field"),
    (rec('"tripID":"t6",' + FULL.replace('"fare_details":{"k":1}', '"fare_details":null')), None),
    (rec('"tripID":"t7",' + FULL.replace(',"fare_details":{"k":1}', "")), "missing_field"),
    (rec('"tripID":"t8",' + FULL.replace('"fare_details":{"k":1}', '"fare_details":"s"')), "missing_field"),
    (rec('"tripID":"t9",' + FULL.replace('"2024-01-15 10:00:00"', "null")), None),
    (rec('"tripID":"t10",' + FULL.replace('"tpep_pickup_datetime":"2024-01-15 10:00:00",', "")), "missing_field"),
    (rec('"tripID":"a","tripID":"b",' + FULL), None),
    (rec('"tripID":" ",' + FULL), None),
]


def test_edge_table(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "offset long, record string")
    got = {r.offset: r for r in parse_records(df, now=now(), keep=["offset"]).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i].reason == want, (i, CASES[i][0], got[i].reason)
    ok = got[0]
    assert ok.primary_passenger == '{"user_id":7,"w":1.5}'  # compact text of the object
    assert ok.tpep_pickup_datetime == dt.datetime(2024, 1, 15, 10)
    assert got[10].fare_details == ""                      # null nested -> ""
    assert got[13].tpep_pickup_datetime == dt.datetime(2000, 1, 1) and got[13].date_fallback
    assert got[15].tripID == "b"                            # repeated key: last wins


def test_every_row_lands_once(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "offset long, record string")
    chk = parse_records(df, now=now(), keep=["offset"])
    assert good_rows(chk).count() + reject_rows(chk).count() == len(CASES)
    for c in good_rows(chk).columns:  # required columns are never null in the data
        assert good_rows(chk).where(F.col(c).isNull()).count() == 0
    m = mapper_counters(chk).first()
    bad = sum(1 for _, w in CASES if w)
    assert (m.total, m.success, m.failure) == (len(CASES), len(CASES) - bad, bad)
    assert filter_counters(chk).first().nulls == bad


def test_preview(spark):
    df = spark.createDataFrame([("x" * 250,), ("short",), (None,)], "s string")
    got = [r[0] for r in df.select(preview("s")).collect()]
    assert got == ["x" * 200 + "... (50 more bytes)", "short", "null"]


def test_filter_does_not_reparse(spark):
    df = spark.createDataFrame([(1, rec('"tripID":"t1",' + FULL))], "offset long, record string")
    plan = parse_records(df, now=now(), keep=["offset"]).where("reason IS NULL")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_null_in_each_required_column(spark):
    """A null scalar is a reject; a null date takes the clock; a null nested value becomes ""."""
    import json

    base = {"tripID": "t", "VendorID": "1", "tpep_pickup_datetime": "2024-01-15 10:00:00",
            "tpep_dropoff_datetime": "2024-01-15 10:10:00", "passenger_count": "2", "trip_distance": "3.5",
            "RatecodeID": "1", "store_and_fwd_flag": "N", "PULocationID": "10", "DOLocationID": "20",
            "payment_type": "card", "primary_passenger": {"u": 1}, "fare_details": {"k": 1}}
    rows = []
    for i, c in enumerate(base):
        d = dict(base)
        d[c] = None
        rows.append((i, json.dumps(d)))
    got = {r.offset: r for r in parse_records(spark.createDataFrame(rows, "offset long, record string"),
                                              now=now(), keep=["offset"]).collect()}
    for i, c in enumerate(base):
        r = got[i]
        if c == "tripID":
            assert r.reason == "missing_trip_id"
        elif c.startswith("tpep_"):
            assert r.reason is None and r.date_fallback and r[c] == dt.datetime(2000, 1, 1)
        elif c in ("primary_passenger", "fare_details"):
            assert r.reason is None and r[c] == ""
        else:
            assert r.reason == "missing_field", c
