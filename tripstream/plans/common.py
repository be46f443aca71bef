"""Shared inputs of the query plans: session prep, feeds, trips, fixture table."""

from __future__ import annotations

import datetime as _dt
import threading

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripstream.config import ensure_checkpoint_dir, scratch_root, ship_package
from tripstream.operators.framing import frame_records
from tripstream.operators.parse import parse_records
from tripstream.operators.quality import good_rows
from tripstream.sinks.snapshot_table import SnapshotTable
from tripstream.sources.feed import FeedRules, trip_messages

# Fixed clock for the "now" fallback, so results repeat.
FIXED_NOW = _dt.datetime(2000, 1, 1, 0, 0, 0)

# Snapshot fixture: batch = floor((day(pickup) - 1) / 10); ids deliberately
# not in commit order; commit time = 2024-01-01 + 10 * (batch + 1) days.
SNAPSHOT_IDS = {0: 300, 1: 100, 2: 200}


def snapshot_id_of(batch: int) -> int:
    return SNAPSHOT_IDS.get(batch, 1000 + batch)


def committed_at_of(batch: int) -> _dt.datetime:
    return _dt.datetime(2024, 1, 1) + _dt.timedelta(days=10 * (batch + 1))


def prepare(spark: SparkSession) -> None:
    """UTC session clock, shared checkpoint dir, package on the workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def fixed_now() -> Column:
    # from text: a Python datetime literal would pass through the session zone
    return F.lit(FIXED_NOW.isoformat(sep=" ")).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    # a row of events becomes messages ten times its size, and the files may be few and small:
    # the rows are dealt to all cores first
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "event_id")


def messages(spark: SparkSession, sf_dir: str, rules: FeedRules = FeedRules(), **kw) -> DataFrame:
    return trip_messages(dealt(events(spark, sf_dir)), rules, **kw)


def staged(rows: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows, written once to the shared scratch folder (in folders by ``by``), for several reads."""
    path = scratch_root(rows.sparkSession, label)
    w = rows.write
    (w.partitionBy(by) if by else w).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def quoted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event an object whose strings hold braces, quotes and escapes, after a stray
    quote for every seventh, cut in two after ``1 + event_id % 40`` characters."""
    i = F.col("event_id")
    text = F.concat(F.when(i % 7 == 0, F.lit('"')).otherwise(F.lit("")), F.lit('{"id":"e'), i.cast("string"),
                    F.lit('","note":"}{\\"'), F.col("event_type"), F.lit('\\\\","n":{"k}":"{"}}'))
    at = (i % 40 + 1).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("k"), F.substring(text, F.lit(1), at).alias("v")),
                     F.struct(F.lit(1).alias("k"), F.substring(text, at + 1, F.lit(1 << 20)).alias("v")))
    return (dealt(events(spark, sf_dir)).select(i, F.explode(halves).alias("h"))
            .select(F.col("h.v").cast("binary").alias("value"), F.lit("t").alias("topic"),
                    (i % 4).cast("int").alias("partition"), (F.floor(i / 4) * 2 + F.col("h.k")).cast("long").alias("offset")))


def checked(spark: SparkSession, sf_dir: str, rules: FeedRules = FeedRules(), **kw) -> DataFrame:
    """Messages -> framing -> parse + check, with the fixed clock."""
    recs = frame_records(messages(spark, sf_dir, rules, **kw))
    return parse_records(recs, now=fixed_now())


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13-column trips of the standard feed."""
    return good_rows(checked(spark, sf_dir))


_TABLES: dict[tuple, SnapshotTable] = {}
_LOCK = threading.Lock()


def fixture_table(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """Trips of the standard feed appended as one snapshot per batch of days.

    Built once per Spark context and input folder, under the shared
    checkpoint dir.
    """
    key = (id(spark.sparkContext._jsc), sf_dir)
    with _LOCK:
        if key in _TABLES:
            return _TABLES[key]
        table = SnapshotTable(spark, scratch_root(spark, "fixture"))
        table.ensure()
        rows = checked(spark, sf_dir).withColumn(
            "_batch", F.floor((F.dayofmonth("tpep_pickup_datetime") - 1) / 10).cast("int"))
        # each append reads its batch and columns only
        rows = staged(rows, "fixture-rows", by="_batch")
        batches = sorted(r[0] for r in rows.select("_batch").where(F.col("reason").isNull())
                         .distinct().collect())
        for b in batches:
            table.append_checked(rows.where(F.col("_batch") == b).drop("_batch"), persist=False,
                                 batch_id=b, snapshot_id=snapshot_id_of(b),
                                 committed_at=committed_at_of(b))
        _TABLES[key] = table
        return table
