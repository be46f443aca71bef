"""Schemas of the messages, the trip table, rejects and the commit log."""

from pyspark.sql import types as T

# The 13 trip columns and their order, as the table declares them.
TRIP_COLUMNS = [
    "tripID",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "primary_passenger",
    "fare_details",
]

DATE_COLUMNS = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
NESTED_COLUMNS = ["primary_passenger", "fare_details"]
SCALAR_COLUMNS = [c for c in TRIP_COLUMNS if c not in DATE_COLUMNS + NESTED_COLUMNS]

TRIP_SCHEMA = T.StructType(
    [
        T.StructField(
            c,
            T.TimestampNTZType() if c in DATE_COLUMNS else T.StringType(),
            False,
        )
        for c in TRIP_COLUMNS
    ]
)

# Every key read as text; nested objects come back as their compact JSON text.
CORRUPT_COLUMN = "_corrupt_record"
JSON_READ_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in TRIP_COLUMNS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Columns of a Kafka record as Spark's Kafka source exposes them.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("reason", T.StringType(), False),
        T.StructField("record", T.StringType(), True),
        T.StructField("raw_preview", T.StringType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        # of a long_record: the message that the piece comes from (offset is the record's)
        T.StructField("piece_offset", T.LongType(), True),
    ]
)

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_seq", T.IntegerType(), False),
        T.StructField("snapshot_id", T.LongType(), False),
        T.StructField("parent_id", T.LongType(), True),
        T.StructField("committed_at", T.TimestampNTZType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("added_rows", T.LongType(), False),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("query_id", T.StringType(), True),
        # the last batch of each query up to this commit ("" for appends without one)
        T.StructField("batches", T.MapType(T.StringType(), T.LongType()), True),
    ]
)

# Reject reasons, in the order they are tested: a row counts under the first.
REASONS = ["unplaced", "open_record", "long_record", "bad_shape", "bad_json", "missing_trip_id", "missing_field"]
