"""Spark settings the pipelines rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Windows are aligned to the epoch; one zone for reading, windowing, output.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Needed by the keyed streaming operators; state lives off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone on a session someone else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
