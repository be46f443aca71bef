"""Parse framed JSON records into the 13-column trip row and check them.

P1-P4, T1-T3 and V1-V5 are one projection: the record is parsed once into
a struct of strings; each rule is a column. Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripstream.functions.dates import parse_lenient, parse_strict
from tripstream.functions.text import java_trim, preview
from tripstream.schema import (
    CORRUPT_COLUMN,
    DATE_COLUMNS,
    JSON_READ_SCHEMA,
    NESTED_COLUMNS,
    SCALAR_COLUMNS,
    TRIP_COLUMNS,
)

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
}


def reason_column(text: Column, j: Column, still_open: Column | None = None, part: Column | None = None) -> Column:
    """First failed rule: open_record, long_record, bad_shape, bad_json, missing_trip_id, missing_field."""
    shape_ok = text.isNotNull() & (F.length(text) > 0) & text.startswith("{") & text.endswith("}")
    bad_json = j[CORRUPT_COLUMN].isNotNull()
    trip_id = j["tripID"]
    no_trip_id = trip_id.isNull() | (trip_id == "")
    scalar_null = F.lit(False)
    for c in SCALAR_COLUMNS:
        if c != "tripID":
            scalar_null = scalar_null | j[c].isNull()
    not_object = F.lit(False)
    for c in NESTED_COLUMNS:
        not_object = not_object | (j[c].isNotNull() & ~F.ltrim(j[c]).startswith("{"))
    # A null date or nested value is allowed; an absent key is not. Keys are
    # listed only for rows that have such a null, so most rows parse once.
    nullable = F.array_compact(F.array(*[F.when(j[c].isNull(), F.lit(c)) for c in DATE_COLUMNS + NESTED_COLUMNS]))
    absent = F.when(F.size(nullable) > 0,
                    F.size(F.array_except(nullable, F.json_object_keys(text))) > 0).otherwise(F.lit(False))
    false = F.lit(False)
    r = (F.when(false if still_open is None else still_open, "open_record")
         .when(false if part is None else part.isNotNull(), "long_record"))
    return (r.when(~shape_ok, "bad_shape").when(bad_json, "bad_json")
            .when(no_trip_id, "missing_trip_id")
            .when(scalar_null | not_object | absent, "missing_field"))


def parse_records(records: DataFrame, record_col: str = "record", now: Column | None = None,
                  lenient: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Checked rows: the 13 trip columns, ``reason`` (null when good),
    ``record`` (the whole trimmed text), ``raw_preview`` (P7 of it),
    ``date_fallback`` and the columns named in ``keep`` (origin columns by
    default). Rows flagged ``open`` by framing are pieces of a record that
    never closed, rows with a ``piece_offset`` those of one too long to be put
    together: rejects.
    """
    keep = keep if keep is not None else [c for c in ("topic", "partition", "offset") if c in records.columns]
    has_open, has_long = "open" in records.columns, "piece_offset" in records.columns
    if has_long and "piece_offset" not in keep:
        keep = [*keep, "piece_offset"]
    text = java_trim(F.col(record_col))
    staged = records.select(*keep, text.alias("_t"),
                            *([F.col("open")] if has_open else []))
    t = F.col("_t")
    shape_ok = t.isNotNull() & t.startswith("{") & t.endswith("}")
    if has_long:
        shape_ok &= F.col("piece_offset").isNull()
    # The parsed struct comes out of a generator (a one-element explode), so a
    # later filter on ``reason`` is not rewritten to parse the text once per
    # tested field: predicates do not share common subexpressions.
    staged = staged.select(
        "*", F.explode(F.array(F.when(shape_ok, F.from_json(t, JSON_READ_SCHEMA, JSON_OPTIONS)))).alias("_j"))
    j = F.col("_j")
    # each date is parsed once, into its own column, and read twice below
    parse = parse_lenient if lenient else parse_strict
    staged = staged.select("*", *[parse(j[c]).alias(f"_d_{c}") for c in DATE_COLUMNS])
    fallback_clock = (now if now is not None else F.current_timestamp()).cast("timestamp_ntz")
    fallback = F.lit(False)
    cols = []
    for c in TRIP_COLUMNS:
        if c in DATE_COLUMNS:
            cols.append(F.coalesce(F.col(f"_d_{c}"), fallback_clock).alias(c))
            fallback = fallback | F.col(f"_d_{c}").isNull()
        elif c in NESTED_COLUMNS:
            cols.append(F.coalesce(j[c], F.lit("")).alias(c))
        else:
            cols.append(j[c].alias(c))
    reason = reason_column(t, j, F.col("open") if has_open else None,
                           F.col("piece_offset") if has_long else None)
    return staged.select(
        *keep, *cols,
        reason.alias("reason"),
        t.alias("record"),
        preview(t).alias("raw_preview"),
        fallback.alias("date_fallback"),
    )
