"""Row shapes shared by the sources, the operators and the sinks."""

from pyspark.sql import types as T

MEASUREMENT = T.StructType(
    [
        T.StructField("identifier", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("payload_ts_ms", T.LongType()),
        T.StructField("value_w", T.DoubleType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)

REGISTRY_EVENT = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)

RESULT = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("identifier", T.StringType()),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("sum_w", T.DoubleType()),
        T.StructField("average_w", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

# The payload of one reading as it travels on a message bus (JSON or Avro).
READING_PAYLOAD = T.StructType(
    [
        T.StructField("identifier", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("valueInW", T.DoubleType()),
    ]
)

# Event types that carry a registry snapshot.
REGISTRY_SNAPSHOT_EVENTS = ("SENSOR_REGISTRY_CHANGED", "SENSOR_REGISTRY_STATUS")
