"""Rate-limited emission of a changelog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.running import Running, with_running
from treewatt.functions.tables import write_table

_GROUP = ["window_start", "identifier"]


def throttled_emission(
    changelog: DataFrame, measurements: DataFrame, cfg: RollupConfig
) -> DataFrame:
    """At most one result per group, window and emit period of stream time.

    An update opens an entry for its (window, group), later updates overwrite it, and it
    is released once stream time reaches the opening update's record time plus the emit
    period. Adds ``entry_time``, the record time of the opening update. Entries that are
    still open when the input ends are not part of the result.
    """
    end = measurements.agg(F.unix_micros(F.max("event_time"))).first()[0]
    return throttle(changelog, end, cfg)[0]


def throttle(
    changelog: DataFrame, end_micros: int | None, cfg: RollupConfig, carried: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Released results, and the entries still open at stream time ``end_micros``.

    ``carried`` are the open entries of an earlier call, whose changelog came before.

    An update whose own record time is old enough is released at once, and takes nothing
    with it: record times only grow within a group, so an entry opened earlier is due no
    later. The other updates fall into entries one after the other: if an update opens
    one, the next opener is the first update whose stream time reaches its due time. That
    successor is found for every update at once, and the openers are what the first update
    of a group reaches, found by doubling the length of the jumps: the rounds grow with the
    logarithm of the entries of a group.
    """
    period = cfg.emit_period_ms * 1000
    columns = changelog.columns
    updates = changelog.withColumn("entry_time", F.col("event_time")).withColumn(
        "_order", F.col("arrival_seq")
    )
    if carried is not None:
        # At most one per group, and older than every update of this changelog.
        before = F.lit(-1).cast("bigint").alias("_order")
        updates = updates.unionByName(carried.select(*columns, "entry_time", before))
    rows = write_table(
        updates.select(
            "*",
            F.unix_micros("stream_time").alias("_clock"),
            (F.unix_micros("entry_time") + F.lit(period)).alias("_due"),
        ),
        "changelog",
    )
    result = [*columns, "entry_time"]
    released = rows.where("_clock >= _due").select(*result)

    waiting = rows.where("_clock < _due")
    openers = _openers(waiting)
    entry_due = _first_beyond(
        openers.select(*_GROUP, F.col("_due").alias("_at"), F.col("_due").alias("_value")),
        waiting.select(*_GROUP, F.col("_clock").alias("_at")),
        reached=False,
    ).withColumnRenamed("_value", "_entry_due")
    placed = waiting.join(entry_due.withColumnRenamed("_at", "_clock"), [*_GROUP, "_clock"])
    newest = [F.max_by(c, "_order").alias(c) for c in columns if c not in _GROUP]
    entries = write_table(
        placed.groupBy(*_GROUP, "_entry_due").agg(
            *newest, F.min_by("entry_time", "_order").alias("entry_time")
        ),
        "entries",
    )
    is_due = F.col("_entry_due") <= F.lit(end_micros).cast("bigint")
    return (
        released.unionByName(entries.where(is_due).select(*result)),
        entries.where(~is_due).select(*result),
    )


def _first_beyond(points: DataFrame, asked: DataFrame, reached: bool) -> DataFrame:
    """For each asked (group, _at) the smallest _value of the group's points from there on.

    With ``reached`` a point at the asked time itself counts. Points and questions are
    reduced to one row per group and time and scanned from the newest to the oldest in
    chunks, so no group is one task.
    """
    nothing = F.lit(None).cast("bigint").alias("_value")
    times = write_table(
        points.select(*_GROUP, "_at", "_value")
        .unionByName(asked.select(*_GROUP, "_at", nothing))
        .groupBy(*_GROUP, "_at")
        .agg(F.min("_value").alias("_value"))
        .withColumn("_back", -F.col("_at")),
        "times",
    )
    scanned = with_running(
        times.withColumnRenamed("_value", "_own"),
        _GROUP,
        "_back",
        [Running("_value", "min", "_own", before=not reached)],
    )
    return scanned.select(*_GROUP, "_at", "_value").where("_value IS NOT NULL")


def _openers(waiting: DataFrame) -> DataFrame:
    """(group, _order, _due) of the updates that open an entry."""
    updates = waiting.select(*_GROUP, "_order", "_clock", "_due")
    following = _first_beyond(
        updates.select(*_GROUP, F.col("_clock").alias("_at"), F.col("_order").alias("_value")),
        updates.select(*_GROUP, F.col("_due").alias("_at")),
        reached=True,
    ).select(*_GROUP, F.col("_at").alias("_due"), F.col("_value").alias("_to"))
    jumps = write_table(
        updates.join(following, [*_GROUP, "_due"]).select(*_GROUP, "_order", "_to"), "jumps"
    )
    marked = write_table(updates.groupBy(*_GROUP).agg(F.min("_order").alias("_order")), "marked")
    while not jumps.isEmpty():
        further = jumps.join(marked, [*_GROUP, "_order"]).select(
            *_GROUP, F.col("_to").alias("_order")
        )
        marked = write_table(marked.unionByName(further), "marked")
        then = jumps.select(*_GROUP, F.col("_order").alias("_to"), F.col("_to").alias("_then"))
        jumps = write_table(
            jumps.join(then, [*_GROUP, "_to"]).select(
                *_GROUP, "_order", F.col("_then").alias("_to")
            ),
            "jumps",
        )
    return updates.join(marked, [*_GROUP, "_order"]).select(*_GROUP, "_order", "_due")
