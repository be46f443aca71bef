"""Kafka-shaped trip messages derived from the ``events`` table.

This is the test and bench input: Spark turns every event into one JSON
trip object (FIXTURES.md §2-3) and lays the objects out as messages of a
topic with four partitions, with the message variants of FIXTURES.md §4
(split objects, several objects in one message, tombstones, blanks, stray
braces, and on request broken rows). It is one scan of ``events`` plus a
small grouping for the packed messages, so it grows with the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tripstream.config import JobOptions
from tripstream.functions.dates import REFERENCE_PATTERNS


@dataclass(frozen=True)
class FeedRules:
    """Which event ids get which message variant (rules on ``event_id``)."""

    partitions: int = 4
    split: bool = True
    split_mod: int = 7          # id % 7 == 0: object cut over several messages
    split_at: tuple = (20,)     # ... after these many characters (at most 3 cuts)
    pack: bool = True
    pack_mod: int = 5           # id % 5 == 3: packed with its neighbours
    pack_rem: int = 3
    pack_span: int = 40         # ids of one partition within 40 share a message
    tombstone_mod: int = 9      # id % 9 == 4: extra null message
    tombstone_rem: int = 4
    blank_rem: int = 5          # id % 9 == 5: extra blank message
    stray_mod: int = 23         # id % 23 == 6: extra message "}"
    stray_rem: int = 6
    # broken rows, only when ``faults=True``
    bad_json_mod: int = 13
    empty_id_mod: int = 17
    missing_key_mod: int = 19
    # unreadable dates, only when ``bad_dates=True``
    bad_date_mod: int = 11


def _fmt(ts: Column, i: Column) -> Column:
    """Format ``ts`` with one of the four layouts, picked by ``i % 4``."""
    k = F.pmod(i, F.lit(4))
    out = None
    for n, pattern in enumerate(REFERENCE_PATTERNS):
        branch = F.date_format(ts, pattern)
        out = F.when(k == n, branch) if out is None else out.when(k == n, branch)
    return out


def trip_json(events: DataFrame, rules: FeedRules = FeedRules(), faults: bool = False,
              bad_dates: bool = False) -> DataFrame:
    """One JSON text per event: columns ``event_id, ts, json``."""
    i = F.col("event_id")
    pickup = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    dropoff = pickup + F.expr("INTERVAL 10 MINUTES")
    pickup_txt = _fmt(pickup, i)
    dropoff_txt = _fmt(dropoff, i)
    if bad_dates:
        bad = F.pmod(i, F.lit(rules.bad_date_mod)) == 0
        pickup_txt = F.when(bad, F.lit("not a date")).otherwise(pickup_txt)
        dropoff_txt = F.when(bad, F.lit("")).otherwise(dropoff_txt)
    trip_id = F.concat(F.lit("e"), i.cast("string"))
    if faults:
        trip_id = F.when(F.pmod(i, F.lit(rules.empty_id_mod)) == 0, F.lit("")).otherwise(trip_id)
    fields = [
        trip_id.alias("tripID"),
        (F.pmod(F.col("user_id"), F.lit(2)) + 1).cast("string").alias("VendorID"),
        pickup_txt.alias("tpep_pickup_datetime"),
        dropoff_txt.alias("tpep_dropoff_datetime"),
        (F.pmod(i, F.lit(6)) + 1).cast("string").alias("passenger_count"),
        F.col("value").cast("string").alias("trip_distance"),
        (F.pmod(i, F.lit(5)) + 1).cast("string").alias("RatecodeID"),
        F.when(F.pmod(i, F.lit(10)) == 0, "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.col("user_id").cast("string").alias("PULocationID"),
        F.pmod(i, F.lit(265)).cast("string").alias("DOLocationID"),
        F.col("event_type").alias("payment_type"),
        F.struct(F.col("user_id"), F.col("event_type")).alias("primary_passenger"),
    ]
    body = F.to_json(F.struct(*fields))
    # fare_details is the event's own JSON object, pasted in as it is.
    text = F.concat(F.expr("substring(__b, 1, length(__b) - 1)"), F.lit(',"fare_details":'),
                    F.col("props"), F.lit("}"))
    out = events.select("event_id", "ts", body.alias("__b"), "props").select(
        "event_id", "ts", text.alias("json"))
    if faults:
        j = F.col("json")
        out = out.withColumn(
            "json",
            F.when(F.pmod(i, F.lit(rules.bad_json_mod)) == 0,
                   F.regexp_replace(j, r'"tripID":"[^"]*"', '"tripID":'))
            .when(F.pmod(i, F.lit(rules.missing_key_mod)) == 0,
                  F.regexp_replace(j, r'"VendorID":"[^"]*",', ""))
            .otherwise(j),
        )
    return out


def trip_messages(events: DataFrame, rules: FeedRules = FeedRules(), faults: bool = False,
                  bad_dates: bool = False, topic: str = JobOptions.topic,
                  extras: bool = True) -> DataFrame:
    """Messages with Kafka's columns: ``key, value, topic, partition, offset, timestamp``.

    Offsets: event ``i`` owns the eight offsets ``8*(i div 4) + k`` of
    partition ``i % 4``; k=0..3 carry its object (k>0 only when split),
    k=4,5 the extra tombstone / blank / stray-brace messages.
    """
    r = rules
    i = F.col("event_id")
    j = trip_json(events, r, faults=faults, bad_dates=bad_dates)
    part = F.pmod(i, F.lit(r.partitions)).cast("int")
    slot = F.floor(i / F.lit(r.partitions)).cast("long") * 8
    packed = (F.pmod(i, F.lit(r.pack_mod)) == r.pack_rem) if r.pack else F.lit(False)
    split = ((F.pmod(i, F.lit(r.split_mod)) == 0) & ~packed) if r.split else F.lit(False)
    text = F.col("json")
    cuts = list(r.split_at)[:3]

    def msg(k: int, value: Column, keep: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), value.alias("v"), keep.alias("keep"))

    bounds = [0] + cuts
    parts = [msg(0, F.when(split, F.substring(text, 1, cuts[0])).otherwise(text), ~packed)]
    for k, lo in enumerate(cuts, start=1):
        hi = bounds[k + 1] if k + 1 < len(bounds) else None
        piece = (F.expr(f"substring(json, {lo + 1}, {hi - lo})") if hi is not None
                 else F.expr(f"substring(json, {lo + 1})"))
        parts.append(msg(k, piece, split))
    if extras:
        parts += [
            msg(4, F.when(F.pmod(i, F.lit(r.tombstone_mod)) == r.tombstone_rem, F.lit(None))
                .otherwise(F.lit(" \t ")),
                F.pmod(i, F.lit(r.tombstone_mod)).isin(r.tombstone_rem, r.blank_rem)),
            msg(5, F.lit("}"), F.pmod(i, F.lit(r.stray_mod)) == r.stray_rem),
        ]
    single = (
        j.select(i.alias("event_id"), "ts", part.alias("partition"), slot.alias("slot"),
                 F.explode(F.array(*parts)).alias("m"))
        .where(F.col("m.keep"))
        .select(
            F.when(F.col("m.k") <= 3, F.concat(F.lit("e"), i.cast("string"))).cast("binary").alias("key"),
            F.col("m.v").cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            "partition",
            (F.col("slot") + F.col("m.k")).alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )
    )
    # Packed: ids of one partition within ``pack_span`` share one message,
    # written as a JSON array with commas and spaces between the objects.
    grp = j.where(packed).groupBy(
        part.alias("partition"), F.floor(i / F.lit(r.pack_span)).alias("g")
    ).agg(
        F.min(slot).alias("offset"),
        F.min("ts").alias("ts"),
        F.array_sort(F.collect_list(F.struct(i.alias("id"), text.alias("t")))).alias("objs"),
    )
    packed_msgs = grp.select(
        F.lit(None).cast("binary").alias("key"),
        F.concat(F.lit("[ "), F.array_join(F.expr("transform(objs, o -> o.t)"), " , "),
                 F.lit(" ]")).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return single.unionByName(packed_msgs)
