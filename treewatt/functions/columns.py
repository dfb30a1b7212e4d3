"""Column expressions: windows, replay order, sums and averages."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig

# Above every bigint, so (payload time, arrival) packs into one decimal(38).
_ARRIVAL_SPAN = Decimal(10**19)


def window_length(cfg: RollupConfig) -> str:
    return f"{cfg.emit_period_ms} milliseconds"


def with_window_start(df: DataFrame, cfg: RollupConfig, time: str = "event_time") -> DataFrame:
    """Add the start of the tumbling window each row falls into."""
    return df.withColumn("window_start", F.window(time, window_length(cfg))["start"])


def window_end(cfg: RollupConfig, start: str = "window_start") -> Column:
    return F.timestamp_micros(F.unix_micros(start) + F.lit(cfg.emit_period_ms * 1000))


def slot_index(micros: Column, cfg: RollupConfig) -> Column:
    """Number of whole windows between the epoch and a time in microseconds."""
    period = F.lit(cfg.emit_period_ms * 1000)
    return ((micros - F.pmod(micros, period)) / period).cast("bigint")


def replay_order(cfg: RollupConfig | None = None) -> Column:
    """Sort key "payload time, then arrival" as one number.

    A struct would order the same way, but an aggregate buffer holding a struct forces a
    sort-based aggregate; numbers stay in the hash aggregate. Within stated bounds the
    number is a bigint, otherwise a decimal.
    """
    payload, arrival = F.col("payload_ts_ms"), F.col("arrival_seq")
    if cfg is None or cfg.order_bounds is None:
        return packed_order(payload, arrival)
    (low_ts, high_ts), (low_seq, high_seq) = cfg.order_bounds
    outside = ~(payload.between(low_ts, high_ts) & arrival.between(low_seq, high_seq))
    refused = F.raise_error(
        F.concat_ws(" ", F.lit("reading outside order_bounds:"), payload, arrival)
    )
    shifted = F.shiftleft(payload - F.lit(low_ts), (high_seq - low_seq).bit_length())
    return F.coalesce(F.when(outside, refused), shifted + (arrival - F.lit(low_seq)))


def measure_order(measurements: DataFrame, cfg: RollupConfig) -> RollupConfig:
    """The configuration with ``order_bounds`` of the input, unchanged if too wide.

    One aggregate over two columns, worth it before a job that reads a large input.
    """
    low = measurements.agg(
        F.min("payload_ts_ms").alias("low_ts"),
        F.max("payload_ts_ms").alias("high_ts"),
        F.min("arrival_seq").alias("low_seq"),
        F.max("arrival_seq").alias("high_seq"),
    ).first()
    if low.low_ts is None:
        return cfg
    bits = (low.high_ts - low.low_ts).bit_length() + (low.high_seq - low.low_seq).bit_length()
    if bits > 63:
        return cfg
    bounds = ((low.low_ts, low.high_ts), (low.low_seq, low.high_seq))
    return replace(cfg, order_bounds=bounds)


def packed_order(first: Column, second: Column) -> Column:
    """Two non-negative bigints as one number that sorts by the first, then the second."""
    return (
        first.cast("decimal(19,0)") * F.lit(_ARRIVAL_SPAN) + second.cast("decimal(19,0)")
    ).cast("decimal(38,0)")


def summable(value: Column, cfg: RollupConfig, averaged: bool = False) -> Column:
    """The form a value takes inside a sum: whole units of 10^-scale, or the double.

    A value with more decimals than the scale raises; an average, which has decimals of its
    own, is rounded to it. So is no reading ever changed.
    """
    if cfg.sum_scale is None:
        return value.cast("double")
    scale = F.lit(float(10**cfg.sum_scale))
    units = F.round(value * scale).cast("bigint")
    if averaged:
        return units
    refused = F.raise_error(F.concat_ws(" ", F.lit("more decimals than sum_scale holds:"), value))
    return F.coalesce(F.when(units.cast("double") / scale != value, refused.cast("bigint")), units)


def child_units(value: Column, cfg: RollupConfig) -> Column:
    """summable of the value of a child, which is an average if children are averaged."""
    return summable(value, cfg, averaged=cfg.child_agg == "avg")


def from_summable(total: Column, cfg: RollupConfig) -> Column:
    if cfg.sum_scale is None:
        return total
    return total.cast("double") / F.lit(float(10**cfg.sum_scale))


def guarded_average(total: Column, count: Column) -> Column:
    """Average that is 0.0 for an empty group."""
    return F.when(count == 0, F.lit(0.0)).otherwise(total / count)


def result_columns(
    cfg: RollupConfig,
    identifier: str,
    count: str,
    total: str,
    timestamp: str,
    extra: tuple[str, ...] = ("event_time",),
) -> list[Column]:
    """Projection from partial aggregates to the public result shape."""
    sum_w = from_summable(F.col(total), cfg)
    bounds = (
        []
        if cfg.drop_window
        else [F.col("window_start"), window_end(cfg).alias("window_end")]
    )
    return [
        *bounds,
        F.col(identifier).alias("identifier"),
        F.col(timestamp).alias("timestamp_ms"),
        F.col(count).cast("bigint").alias("count"),
        sum_w.alias("sum_w"),
        guarded_average(sum_w, F.col(count)).alias("average_w"),
        *[F.col(name) for name in extra],
    ]
