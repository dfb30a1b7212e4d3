"""Measurement and registry-event sources: batch or streaming, any Spark format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treewatt.config import require
from treewatt.schemas import MEASUREMENT, READING_PAYLOAD, REGISTRY_EVENT


def _load(
    spark: SparkSession,
    fmt: str,
    path: str | None,
    schema: T.StructType | None,
    options: Mapping[str, str],
    streaming: bool,
) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_measurements(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    *,
    options: Mapping[str, str] | None = None,
    streaming: bool = False,
    payload_format: str = "json",
    avro_schema: str | None = None,
) -> DataFrame:
    """Readings from files with the measurement schema, or from a Kafka topic.

    Kafka rows carry the reading in ``value`` as JSON or Avro. The record timestamp
    becomes the event time, the offset the arrival order, and the partition is kept as
    ``source_partition``.
    """
    require(fmt=fmt)
    if fmt != "kafka":
        require(path=path)
        return _load(spark, fmt, path, MEASUREMENT, options or {}, streaming)
    require(options=options)
    raw = _load(spark, "kafka", None, None, options, streaming)
    return readings_from_bus(raw, payload_format, avro_schema)


def readings_from_bus(
    raw: DataFrame, payload_format: str = "json", avro_schema: str | None = None
) -> DataFrame:
    """Kafka-shaped rows (key, value, partition, offset, timestamp) to measurements."""
    body = _decode(F.col("value"), payload_format, avro_schema)
    return raw.select(
        body.alias("reading"),
        F.col("timestamp").alias("event_time"),
        F.col("offset").alias("arrival_seq"),
        F.col("partition").cast("int").alias("source_partition"),
    ).select(
        F.col("reading.identifier").alias("identifier"),
        "event_time",
        F.col("reading.timestamp").alias("payload_ts_ms"),
        F.col("reading.valueInW").alias("value_w"),
        "arrival_seq",
        "source_partition",
    )


def _decode(value: Column, payload_format: str, avro_schema: str | None) -> Column:
    if payload_format == "json":
        return F.from_json(value.cast("string"), READING_PAYLOAD)
    if payload_format == "avro":
        require(avro_schema=avro_schema)
        from pyspark.sql.avro.functions import from_avro

        return from_avro(value, avro_schema)
    raise ValueError("payload_format must be json or avro")


def read_registry_events(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    *,
    options: Mapping[str, str] | None = None,
    streaming: bool = False,
) -> DataFrame:
    """Registry events from files, or from a Kafka topic (key = event type)."""
    require(fmt=fmt)
    if fmt != "kafka":
        require(path=path)
        return _load(spark, fmt, path, REGISTRY_EVENT, options or {}, streaming)
    require(options=options)
    return registry_events_from_bus(_load(spark, "kafka", None, None, options, streaming))


def registry_events_from_bus(raw: DataFrame) -> DataFrame:
    """Kafka-shaped rows to registry events; offsets are unique within a partition only, which
    is kept as ``source_partition``."""
    return raw.select(
        F.col("key").cast("string").alias("event_type"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("event_time"),
        F.col("offset").alias("arrival_seq"),
        F.col("partition").cast("int").alias("source_partition"),
    )
