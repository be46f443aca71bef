"""tripstream: land Kafka-shaped JSON trip messages in a day-partitioned,
append-only snapshot table with Spark, and query it.

Everything runs as Spark DataFrame / SQL plans; Python appears only as
small Arrow-batched helpers inside Spark tasks (record framing of split
messages, stateful stream framing).
"""

from tripstream.config import JobOptions, build_session, scratch_root
from tripstream.schema import TRIP_COLUMNS, TRIP_SCHEMA, MESSAGE_SCHEMA

__all__ = [
    "JobOptions",
    "build_session",
    "scratch_root",
    "TRIP_COLUMNS",
    "TRIP_SCHEMA",
    "MESSAGE_SCHEMA",
]
