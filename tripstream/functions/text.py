"""Text helpers as Column expressions (JVM side, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Java's String.trim strips every char <= U+0020 at both ends, not only spaces.
_JAVA_BLANKS = "".join(chr(i) for i in range(0x21))

# Log preview length and its suffix text.
PREVIEW_CHARS = 200


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """trim as Java does (all control chars and spaces), no regex."""
    return F.btrim(_col(c), F.lit(_JAVA_BLANKS))


def decode_utf8(c) -> Column:
    """bytes -> text; malformed UTF-8 becomes U+FFFD, so that lengths and
    positions agree in all later steps."""
    return F.make_valid_utf8(_col(c).cast("string"))


def preview(c, max_chars: int = PREVIEW_CHARS, null_text: str | None = "null") -> Column:
    """First ``max_chars`` chars plus ``... (N more bytes)``.

    N counts characters, as the reference does despite the word bytes.
    A null becomes ``null_text`` (the mapper's copy of the helper writes
    ``"null"``).
    """
    s = _col(c)
    n = F.length(s)
    cut = F.concat(
        F.substring(s, 1, max_chars),
        F.lit("... ("),
        (n - F.lit(max_chars)).cast("string"),
        F.lit(" more bytes)"),
    )
    out = F.when(n <= max_chars, s).otherwise(cut)
    if null_text is not None:
        out = F.when(s.isNull(), F.lit(null_text)).otherwise(out)
    return out


def count_char(c, ch: str) -> Column:
    """Occurrences of one character, without a regex."""
    s = _col(c)
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))
