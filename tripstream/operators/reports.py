"""Queries over the trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripstream.sinks.snapshot_table import SnapshotTable


def count_rows(df: DataFrame) -> DataFrame:
    """A1: ``SELECT COUNT(*)`` (partial counts per task, one final sum)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def count_by_passenger(df: DataFrame) -> DataFrame:
    """A2 + O1: trips per passenger count, most first; ties by the key."""
    return (df.groupBy("passenger_count").agg(F.count(F.lit(1)).alias("trip_count"))
            .orderBy(F.col("trip_count").desc(), F.col("passenger_count")))


def where_text(df: DataFrame, predicate: str) -> DataFrame:
    """V7 + V8: a predicate given as SQL text, e.g. ``trip_distance > '5.0'``.

    On the string column this compares text, as the reference does:
    ``'10.0' > '5.0'`` is false. Catalyst pushes it to the Parquet scan.
    """
    return df.where(predicate)


def distance_over(df: DataFrame, km: float) -> DataFrame:
    """V9: the numeric reading of the same filter."""
    return df.where(F.expr("try_cast(trip_distance AS DOUBLE)") > F.lit(km))


def first_rows(df: DataFrame, n: int = 10, order_by: str | None = None) -> DataFrame:
    """O3: ``LIMIT n``; with ``order_by`` a top-k (TakeOrderedAndProject)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def min_snapshot(log: DataFrame) -> DataFrame:
    """``MIN(snapshot_id)``, the reference's idea of the earliest."""
    return log.agg(F.min("snapshot_id").alias("min_id"))


def earliest_snapshot(log: DataFrame) -> DataFrame:
    """The snapshot committed first (ids are not in time order)."""
    return log.agg(F.min("snapshot_id").alias("min_id"),
                   F.min_by("snapshot_id", "committed_at").alias("earliest_id"))


def nth_newest_snapshot(log: DataFrame, n: int = 1) -> DataFrame:
    """The snapshot ``n`` places behind the newest, without a full collect."""
    return log.orderBy(F.col("committed_at").desc()).offset(n).limit(1).select("snapshot_id")


def rows_per_day(table: SnapshotTable) -> DataFrame:
    """K4: rows per ``pickup_day`` partition of the current snapshot."""
    return table.rows_per_day()
