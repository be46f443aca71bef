"""Column-level functions: text, dates."""

from tripstream.functions.dates import (
    epoch_millis_to_ntz,
    format_datetime,
    parse_datetime,
    parse_lenient,
    parse_strict,
)
from tripstream.functions.text import decode_utf8, java_trim, preview

__all__ = [
    "decode_utf8",
    "epoch_millis_to_ntz",
    "format_datetime",
    "java_trim",
    "parse_datetime",
    "parse_lenient",
    "parse_strict",
    "preview",
]
