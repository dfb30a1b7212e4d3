"""Last values: per sensor, and per sensor and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import from_summable, replay_order, summable, with_window_start


def merge_streams(*measurements: DataFrame) -> DataFrame:
    """Bag union of measurement streams."""
    merged, *others = measurements
    for other in others:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def latest_per_sensor(measurements: DataFrame) -> DataFrame:
    """The reading of each sensor that arrived last."""
    columns = [c for c in measurements.columns if c not in ("identifier", "arrival_seq")]
    return measurements.groupBy("identifier").agg(
        *[F.max_by(c, "arrival_seq").alias(c) for c in columns],
        F.max("arrival_seq").alias("arrival_seq"),
    )


def tumbling_windows(measurements: DataFrame, cfg: RollupConfig) -> DataFrame:
    """Add ``window_start`` and ``window_end`` to each reading."""
    return measurements.select(
        "*", F.window("event_time", f"{cfg.emit_period_ms} milliseconds").alias("_w")
    ).select(
        *measurements.columns,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
    )


def child_value(cfg: RollupConfig) -> Column:
    """How the readings of one child in one window become its value."""
    units = summable(F.col("value_w"), cfg)
    if cfg.child_agg == "last":
        return F.max_by("value_w", replay_order(cfg))
    if cfg.child_agg == "avg":
        return from_summable(F.sum(units), cfg) / F.count("value_w")
    if cfg.child_agg == "sum":
        return from_summable(F.sum(units), cfg)
    return F.max("value_w") if cfg.child_agg == "max" else F.min("value_w")


def value_per_window(
    measurements: DataFrame, cfg: RollupConfig, keys: tuple[str, ...] = ("identifier",)
) -> DataFrame:
    """One row per window and key: the child's value, newest payload and record time.

    With the default ``last`` the value is the one with the newest payload time, the
    later arrival winning a tie. Keys that include a parent give the value per
    (sensor, parent).
    """
    columns = [*keys, "event_time", "payload_ts_ms", "value_w"]
    if cfg.child_agg == "last":
        columns.append("arrival_seq")
    return (
        with_window_start(measurements.select(*columns), cfg)
        .groupBy("window_start", *keys)
        .agg(
            child_value(cfg).alias("value_w"),
            F.max("payload_ts_ms").alias("payload_ts_ms"),
            F.max("event_time").alias("event_time"),
        )
    )
