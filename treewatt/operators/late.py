"""Stream time in arrival order, and the late-reading filter on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import slot_index, window_end, with_window_start
from treewatt.functions.running import Running, with_running
from treewatt.functions.tables import sized, write_table


def with_stream_time(measurements: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``stream_time``: the newest event time among the rows arrived so far.

    ``by`` gives each source its own clock.
    """
    return with_running(
        measurements,
        list(by),
        "arrival_seq",
        [Running("stream_time", "max", "event_time")],
        chunk_bits=(20, 20) if by else (18,),
    )


def unique_arrival(measurements: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Arrival numbers that are unique over all sources and keep the order within each.

    Sources number their readings independently, as the partitions of a bus do. Readings
    take turns by their number, and of equal numbers the source that sorts first leads.
    """
    if not by:
        return measurements
    names = [f"_by_{i}" for i in range(len(by))]
    sources = write_table(
        measurements.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)])
        .distinct()
        .withColumn("_key", F.struct(*names)),
        "sources",
    )
    # One row per source, like the partitions of a bus: few enough for one task.
    ranked = sources.withColumn("_rank", F.row_number().over(Window.orderBy("_key")) - 1)
    count = sources.count()
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)]
    numbered = measurements.join(sized(ranked, count, 100_000), same)
    return numbered.withColumn(
        "arrival_seq", F.col("arrival_seq") * F.lit(count).cast("bigint") + F.col("_rank")
    ).select(*measurements.columns)


def with_release_time(
    measurements: DataFrame,
    by: tuple[str, ...],
    clocks: dict[tuple, int] | None = None,
    released: int | None = None,
) -> DataFrame:
    """Add ``release_time``: the stream time that all sources have reached, as far as they have
    reported by then. It never goes back, also when a source joins that lags behind.

    Arrival numbers are unique over all sources. ``clocks`` (microseconds by the values of
    ``by``) and ``released`` are what earlier calls left. Each source is one running maximum:
    sources are like the partitions of a bus, and are listed on the driver.
    """
    names = {tuple(r) for r in measurements.select(*by).distinct().collect()} | set(clocks or ())
    wanted, newest, rows = [], [], measurements
    for number, name in enumerate(sorted(names, key=repr)):
        same = F.lit(True)
        for column, value in zip(by, name, strict=True):
            same = same & F.col(column).eqNullSafe(F.lit(value))
        rows = rows.withColumn(f"_own_{number}", F.when(same, F.col("event_time")))
        wanted.append(Running(f"_clock_{number}", "max", f"_own_{number}"))
        carried = F.timestamp_micros(F.lit((clocks or {}).get(name)).cast("bigint"))
        newest.append(F.greatest(F.col(f"_clock_{number}"), carried))
    if not names:
        return measurements.withColumn("release_time", F.lit(None).cast("timestamp"))
    scanned = with_running(write_table(rows, "sources"), [], "arrival_seq", wanted)
    least = F.least(*newest, F.lit(None).cast("timestamp")).alias("_least")
    kept = write_table(scanned.select(*measurements.columns, least), "least")
    timed = with_running(
        kept, [], "arrival_seq", [Running("release_time", "max", "_least")]
    )
    floor = F.timestamp_micros(F.lit(released).cast("bigint"))
    return timed.withColumn("release_time", F.greatest("release_time", floor)).drop("_least")


def closing_arrivals(
    measurements: DataFrame, cfg: RollupConfig, by: tuple[str, ...] = ()
) -> DataFrame:
    """``(window_index, closed_by)`` of every window that has late readings.

    A window is closed by the first arrival whose event time is at least the window's
    end plus grace. So instead of a running maximum over all rows, it is enough to know
    the first and last arrival per window-long slot of time: one partial aggregate over
    the input, then a running minimum over the slots, from the newest to the oldest.
    """
    micros = F.unix_micros("event_time")
    index = slot_index(micros, cfg)
    reached = slot_index(micros - F.lit(cfg.grace_period_ms * 1000), cfg)
    reduced = (
        measurements.select(
            *by, index.alias("index"), reached.alias("reached"), "arrival_seq"
        )
        .groupBy(*by, "index", "reached")
        .agg(F.min("arrival_seq").alias("first"), F.max("arrival_seq").alias("last"))
    )
    # A row closes every window before the slot it reaches, and asks, as a member of its
    # own window, for the closing slots after it.
    nothing = F.lit(None).cast("bigint")
    roles = F.array(
        F.struct(
            F.col("reached").alias("slot"),
            F.col("first").alias("first_arrival"),
            nothing.alias("last_member"),
        ),
        F.struct(
            (F.col("index") + 1).alias("slot"),
            nothing.alias("first_arrival"),
            F.col("last").alias("last_member"),
        ),
    )
    slots = (
        reduced.select(*by, F.inline(roles))
        .groupBy(*by, "slot")
        .agg(
            F.min("first_arrival").alias("first_arrival"),
            F.max("last_member").alias("last_member"),
        )
        .withColumn("backwards", -F.col("slot"))
    )
    closed = with_running(
        write_table(slots, "slots"),
        list(by),
        "backwards",
        [Running("closed_by", "min", "first_arrival")],
    )
    return closed.where(F.col("last_member") > F.col("closed_by")).select(
        *by, (F.col("slot") - 1).alias("window_index"), "closed_by"
    )


def with_late_flag(
    measurements: DataFrame, cfg: RollupConfig, by: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``late``: whether the window of a reading had closed when it arrived.

    The closing arrivals are written and counted first. Input without late readings is
    passed through without any join.
    """
    closing = write_table(closing_arrivals(measurements, cfg, by), "closing")
    rows = closing.count()
    if rows == 0:
        return measurements.withColumn("late", F.lit(False))
    index = slot_index(F.unix_micros("event_time"), cfg)
    return (
        measurements.withColumn("window_index", index)
        .join(sized(closing, rows, cfg.broadcast_rows), [*by, "window_index"], "left")
        .select(
            *measurements.columns,
            F.coalesce(F.col("arrival_seq") > F.col("closed_by"), F.lit(False)).alias("late"),
        )
    )


def drop_late(measurements: DataFrame, cfg: RollupConfig, by: tuple[str, ...] = ()) -> DataFrame:
    """Readings that arrived before their window closed."""
    return with_late_flag(measurements, cfg, by).where(~F.col("late")).drop("late")


def accepted_with_stream_time(
    measurements: DataFrame, cfg: RollupConfig, by: tuple[str, ...] = ()
) -> DataFrame:
    """Accepted readings together with the stream time at their arrival."""
    return accepted(with_stream_time(measurements, by), cfg)


def accepted(timed: DataFrame, cfg: RollupConfig) -> DataFrame:
    """Readings with stream time whose window was open then."""
    open_until = F.unix_micros(window_end(cfg)) + F.lit(cfg.grace_period_ms * 1000)
    return with_window_start(timed, cfg).where(open_until > F.unix_micros("stream_time"))
