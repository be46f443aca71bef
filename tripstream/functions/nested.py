"""Nested JSON texts compared and queried by content (P3), through VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_content(c) -> Column:
    """A JSON text in one spelling: keys sorted, no blanks, numbers by value
    (``1.50`` and ``1.5`` are one; a number with an exponent is a double, which is
    spelled another way); null for a text that is not JSON."""
    return F.to_json(F.try_parse_json(_col(c)))


def same_json(a, b) -> Column:
    """Whether two JSON texts have the same content; null if one is not JSON."""
    return json_content(a) == json_content(b)


def json_field(c, path: str, kind: str = "string") -> Column:
    """The value at a path (``$.a.b``, ``$.list[0]``) of a JSON text as ``kind``; null
    where there is none or it does not fit."""
    return F.try_variant_get(F.try_parse_json(_col(c)), path, kind)
