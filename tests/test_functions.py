"""SQL functions equal the column functions; nested JSON by content."""

from pyspark.sql import functions as F

from tripstream.functions import sql
from tripstream.functions.dates import epoch_millis_to_ntz, format_datetime, parse_lenient, parse_strict
from tripstream.functions.nested import json_content, json_field, same_json
from tripstream.functions.text import java_trim, preview

DATES = ["2024-01-15 10:00:00", "2024/1/5 1:2:3", "01/15/2024 10:00:00", "15-01-2024 10:00:00", "2024-01-15 10:00:00.123",
         " 2024-02-30 00:00:00 ", "2024-13-45 25:61:61", "24-01-15 10:00:00", "not a date", "", None, "2024-01-15",
         "99999999999-1-1 1:1:1", "2024-1-1 1:1:99999999", "2024-01-15 10:00:00 tail"]


def test_sql_functions_equal_column_functions(spark):
    assert sql.register(spark) == list(sql.FUNCTIONS)
    df = spark.createDataFrame([(d, "\x01\t " + (d or "") + " x\x1f", 1700000000123 + i) for i, d in enumerate(DATES)],
                               "d string, t string, ms long")
    pairs = {
        "trip_date(d)": parse_strict("d"), "trip_date_lenient(d)": parse_lenient("d"), "java_trim(t)": java_trim("t"),
        "trip_date_text(trip_date(d))": format_datetime(parse_strict("d")), "epoch_to_ntz(ms)": epoch_millis_to_ntz("ms"),
        "log_preview(repeat(d, 20))": preview(F.expr("repeat(d, 20)")), "json_content(d)": json_content("d"),
    }
    for text, column in pairs.items():
        rows = df.select(F.expr(text).alias("a"), column.alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows], text
    plan = df.select(*[F.expr(t) for t in pairs])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert spark.sql("SELECT trip_date('2024-1-5 1:2:3') AS t").schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_nested_json_by_content(spark):
    rows = [('{"a":1,"b":{"c":[1,2.50]}}', '{ "b": {"c":[1.0, 2.5]}, "a": 1.00 }', True),
            ('{"a":1}', '{"a":2}', False), ('{"a":[1,2]}', '{"a":[2,1]}', False), ('{"a":null}', "{}", False),
            ("not json", "{}", None), (None, "{}", None), ('{"a":"1"}', '{"a":1}', False)]
    df = spark.createDataFrame(rows, "a string, b string, same boolean")
    for r in df.select("*", same_json("a", "b").alias("got")).collect():
        assert r.got == r.same, r
    got = df.select(json_field("a", "$.b.c[1]", "double").alias("x"), json_field("a", "$.a", "int").alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(2.5, 1), (None, 1), (None, None), (None, None), (None, None), (None, None), (None, 1)]
