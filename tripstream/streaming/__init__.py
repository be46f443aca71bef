"""Structured Streaming ingest: stateful framing, parse, append per micro-batch."""
