"""Operators: framing, parsing, validation, reports."""
