"""Final-only streaming roll-up out of built-in windowed aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import result_columns, child_units, window_length
from treewatt.operators.hierarchy import Hierarchy
from treewatt.operators.latest import child_value
from treewatt.operators.rollup import leaf_only


def final_results(readings: DataFrame, hierarchy: Hierarchy, cfg: RollupConfig) -> DataFrame:
    """One result per window and group once the watermark has passed the window.

    Three chained aggregates in append mode whatever the depth: last value per sensor,
    then per (group, direct child) through the closure, then per group. The middle one
    keeps a hot root spread over its direct children. Valid when only leaves report.

    The watermark is the newest event time minus the grace period, as of the previous
    micro-batch: a reading is dropped one batch later than its exact limit, never
    earlier. ``IncrementalRollup`` keeps the exact limit.
    """
    length = window_length(cfg)
    closure = hierarchy.sized_closure().withColumnRenamed("leaf", "identifier")
    last = (
        readings.withWatermark("event_time", f"{cfg.grace_period_ms} milliseconds")
        .groupBy(F.window("event_time", length).alias("w"), "identifier")
        .agg(
            child_value(cfg).alias("value_w"),
            F.max("payload_ts_ms").alias("payload_ts_ms"),
            F.max("event_time").alias("event_time"),
        )
    )
    per_child = (
        last.join(closure, "identifier")
        .groupBy(F.window("w", length).alias("w"), "ancestor", "via_child")
        .agg(
            F.sum(child_units(leaf_only("value_w"), cfg) * F.col("paths")).alias("total"),
            F.max("payload_ts_ms").alias("newest"),
            F.max("event_time").alias("event_time"),
        )
    )
    per_group = (
        per_child.groupBy(F.window("w", length).alias("w"), "ancestor")
        .agg(
            F.count("*").alias("n"),
            F.sum("total").alias("total"),
            F.max("newest").alias("newest"),
            F.max("event_time").alias("event_time"),
        )
        .withColumn("window_start", F.col("w.start"))
    )
    return per_group.select(*result_columns(cfg, "ancestor", "n", "total", "newest"))
