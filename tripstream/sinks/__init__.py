"""Sinks: the append-only snapshot table."""
