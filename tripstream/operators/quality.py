"""Validation outputs (V6), reject rows (D6) and counters (A4, A5)."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, functions as F

from tripstream.schema import REJECT_SCHEMA, TRIP_COLUMNS


def good_rows(checked: DataFrame) -> DataFrame:
    """V6: rows that passed every rule, as the 13 trip columns."""
    return checked.where(F.col("reason").isNull()).select(*TRIP_COLUMNS)


def reject_rows(checked: DataFrame) -> DataFrame:
    """Failed rows as ``REJECT_SCHEMA``: reason, the whole text, its preview, origin
    (null where the input has none)."""
    have = [F.col(f.name) if f.name in checked.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in REJECT_SCHEMA]
    return checked.where(F.col("reason").isNotNull()).select(*have)


def reject_report(checked: DataFrame) -> DataFrame:
    """Rejects per reason."""
    return (reject_rows(checked).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("rejects")))


def mapper_counters(checked: DataFrame) -> DataFrame:
    """A4: total, success, failure, success percent (0.0 when total is 0)."""
    ok = F.col("reason").isNull()
    agg = checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("success"),
        F.count_if(~ok).alias("failure"),
    )
    rate = F.when(F.col("total") > 0,
                  F.round(F.col("success") * F.lit(100.0) / F.col("total"), 1)).otherwise(F.lit(0.0))
    return agg.select("total", "success", "failure", rate.alias("success_pct"))


def filter_counters(checked: DataFrame) -> DataFrame:
    """A5: rows seen by the filter, rows dropped as null, null percent."""
    bad = F.col("reason").isNotNull()
    agg = checked.agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("nulls"))
    rate = F.when(F.col("total") > 0,
                  F.round(F.col("nulls") * F.lit(100.0) / F.col("total"), 2)).otherwise(F.lit(0.0))
    return agg.select("total", "nulls", rate.alias("null_pct"))


def observed(checked: DataFrame, obs: Observation) -> DataFrame:
    """A4 / A5 while the data flows (a stream's micro-batch, a write): ``total``,
    ``success`` and ``failure`` of the rows that pass."""
    ok = F.col("reason").isNull()
    return checked.observe(obs, F.count(F.lit(1)).alias("total"),
                           F.count_if(ok).alias("success"), F.count_if(~ok).alias("failure"))


def counts_of(obs: Observation, *names: str, otherwise: Callable[[], dict] | None = None) -> dict:
    """The observed counts. Where adaptive execution found that no row comes out and
    dropped the observed part of the plan, there are none: zeros, or ``otherwise()``."""
    try:
        return obs.get
    except Py4JJavaError:
        return otherwise() if otherwise else dict.fromkeys(names, 0)
