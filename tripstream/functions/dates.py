"""Timestamp parsing and formatting (T1-T5, P5), as Column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

# The four date patterns the reference tries, in its order.
REFERENCE_PATTERNS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
]

# The same four layouts with one-letter fields, so Spark's strict parser
# also reads short fields (2024-1-5 1:2:3) but never another layout.
STRICT_PATTERNS = [
    "yyyy-M-d H:m:s",
    "yyyy/M/d H:m:s",
    "M/d/yyyy H:m:s",
    "d-M-yyyy H:m:s",
]

# Shape each layout needs to read a text: a try is skipped when the text
# cannot match, so no parse is attempted (and failed) in vain.
_STRICT_SHAPES = [
    r"^[+-]?\d{4,}-\d+-\d+ \d+:\d+:\d+$",
    r"^[+-]?\d{4,}/\d+/\d+ \d+:\d+:\d+$",
    r"^\d+/\d+/[+-]?\d{4,} \d+:\d+:\d+$",
    r"^\d+-\d+-[+-]?\d{4,} \d+:\d+:\d+$",
]

OUTPUT_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Lenient reading (T4): the six numbers of the first two layouts, year first,
# each field taken as a plain number and rolled over like a lenient calendar.
_LENIENT_LAYOUTS = [
    r"^(\d+)-(\d+)-(\d+) (\d+):(\d+):(\d+)",
    r"^(\d+)/(\d+)/(\d+) (\d+):(\d+):(\d+)",
]

_LENIENT_MAX = 999_999           # months, days, hours, minutes, seconds roll over up to here

_EPOCH_NTZ = _dt.datetime(1970, 1, 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip_fraction(s: Column) -> Column:
    return F.regexp_replace(F.trim(s), r"\.\d+$", "")


def parse_strict(c) -> Column:
    """First of the four layouts that reads the text; null if none."""
    s = _strip_fraction(_col(c))
    tries = [F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(p)))
             for shape, p in zip(_STRICT_SHAPES, STRICT_PATTERNS)]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_lenient(c) -> Column:
    """T4: lenient reading; out-of-range fields roll over, trailing text ignored."""
    s = F.trim(_col(c))
    outs = []
    for rx in _LENIENT_LAYOUTS:
        # a field out of all bounds makes the text unreadable, never an error
        tops = [9999, *[_LENIENT_MAX] * 5]
        parts = [F.regexp_extract(s, rx, i).try_cast("int") for i in range(1, 7)]
        readable = F.lit(True)
        for x, top in zip(parts, tops):
            readable &= F.coalesce(x.between(0, top), F.lit(False))
        y, mo, d, h, mi, sec = [F.when(readable, x) for x in parts]
        base = F.make_date(y, F.lit(1), F.lit(1)).cast("timestamp_ntz")
        shifted = base + F.make_interval(
            F.lit(0), mo - 1, F.lit(0), d - 1, h, mi, sec.cast("decimal(18,6)")
        )
        outs.append(F.when(s.rlike(rx), shifted))
    return F.coalesce(*outs)


def parse_datetime(c, now: Column | None = None, lenient: bool = False) -> Column:
    """T1 + T2 + T3: parse, and use ``now`` for null, blank or unreadable text.

    ``now`` defaults to ``current_timestamp()`` (the reference's behaviour);
    pass a literal to make results repeatable.
    """
    fallback = now if now is not None else F.current_timestamp()
    parsed = parse_lenient(c) if lenient else parse_strict(c)
    return F.coalesce(parsed, fallback.cast("timestamp_ntz"))


def is_unreadable_date(c, lenient: bool = False) -> Column:
    """Quality flag: the text was null, blank or matched no layout."""
    parsed = parse_lenient(c) if lenient else parse_strict(c)
    return parsed.isNull()


def format_datetime(c) -> Column:
    """T5: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_col(c), OUTPUT_PATTERN)


def epoch_millis_to_ntz(c) -> Column:
    """P5: epoch milliseconds -> TIMESTAMP_NTZ holding the UTC wall clock.

    Plain interval arithmetic from 1970-01-01, so the session zone plays no part.
    """
    secs = (_col(c).cast("decimal(20,3)") / F.lit(1000)).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ.isoformat(sep=" ")).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs
    )
