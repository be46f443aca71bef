"""The column functions as SQL scalar functions.

``register(spark)`` makes temporary functions whose bodies are SQL expressions:
Catalyst puts them into the query, so they run in the JVM inside its plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripstream.functions.dates import (
    _LENIENT_LAYOUTS,
    _LENIENT_MAX,
    _STRICT_SHAPES,
    OUTPUT_PATTERN,
    STRICT_PATTERNS,
)
from tripstream.functions.text import PREVIEW_CHARS

_TRIMMED = r"regexp_replace(trim(s), r'\.\d+$', '')"
_JAVA_BLANKS = "decode(unhex('" + "".join(f"{i:02X}" for i in range(0x21)) + "'), 'UTF-8')"


def _strict() -> str:
    tries = ", ".join(f"CASE WHEN {_TRIMMED} RLIKE r'{shape}' THEN try_to_timestamp({_TRIMMED}, '{pattern}') END"
                      for shape, pattern in zip(_STRICT_SHAPES, STRICT_PATTERNS))
    return f"CAST(coalesce({tries}) AS TIMESTAMP_NTZ)"


def _lenient() -> str:
    outs = []
    for layout in _LENIENT_LAYOUTS:
        y, mo, d, h, mi, sec = (f"try_cast(regexp_extract(trim(s), r'{layout}', {i}) AS INT)" for i in range(1, 7))
        fits = " AND ".join([f"{y} BETWEEN 0 AND 9999", *(f"{x} BETWEEN 0 AND {_LENIENT_MAX}" for x in (mo, d, h, mi, sec))])
        outs.append(f"CASE WHEN trim(s) RLIKE r'{layout}' AND {fits} THEN "
                    f"CAST(make_date({y}, 1, 1) AS TIMESTAMP_NTZ) + make_interval(0, {mo} - 1, 0, {d} - 1, {h}, {mi}, "
                    f"CAST({sec} AS DECIMAL(18, 6))) END")
    return f"coalesce({', '.join(outs)})"


# name: parameters, type, body
FUNCTIONS = {
    "java_trim": ("s STRING", "STRING", f"btrim(s, {_JAVA_BLANKS})"),
    "log_preview": ("s STRING", "STRING",
                    f"CASE WHEN s IS NULL THEN 'null' WHEN length(s) <= {PREVIEW_CHARS} THEN s "
                    f"ELSE concat(substring(s, 1, {PREVIEW_CHARS}), '... (', length(s) - {PREVIEW_CHARS}, ' more bytes)') END"),
    "trip_date": ("s STRING", "TIMESTAMP_NTZ", _strict()),
    "trip_date_lenient": ("s STRING", "TIMESTAMP_NTZ", _lenient()),
    "trip_date_text": ("t TIMESTAMP_NTZ", "STRING", f"date_format(t, '{OUTPUT_PATTERN}')"),
    "epoch_to_ntz": ("ms BIGINT", "TIMESTAMP_NTZ",
                     "TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, "
                     "CAST(CAST(ms AS DECIMAL(20, 3)) / 1000 AS DECIMAL(18, 6)))"),
    "json_content": ("s STRING", "STRING", "to_json(try_parse_json(s))"),
}


def register(spark: SparkSession) -> list[str]:
    """Make (or replace) the temporary functions; returns their names."""
    for name, (params, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
