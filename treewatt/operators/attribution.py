"""Joining readings to the groups they belong to, now and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import packed_order, with_window_start
from treewatt.functions.running import Running, with_previous, with_running
from treewatt.functions.tables import sized, write_table
from treewatt.operators.registry import membership_retractions, versioned_edges

# Sensors with more versions than this are matched by a scan along time instead of a join, in
# which each of their readings would meet each version.
MANY_VERSIONS = 16
_SCAN_BITS = (32, 20)  # half an hour of a sensor's readings, in microseconds, is one chunk


def join_current_parents(
    measurements: DataFrame, parents: DataFrame, parent_rows: int, broadcast_rows: int
) -> DataFrame:
    """Add the current parents of each reading; unknown sensors and the root drop out."""
    known = parents.select(F.col("child").alias("identifier"), "parents")
    return measurements.join(sized(known, parent_rows, broadcast_rows), "identifier")


def fan_out(joined: DataFrame) -> DataFrame:
    """One copy of each reading per parent."""
    columns = [c for c in joined.columns if c != "parents"]
    return joined.select(*columns, F.explode("parents").alias("parent"))


def join_parents_as_of(
    measurements: DataFrame, versions: DataFrame, version_rows: int, broadcast_rows: int
) -> DataFrame:
    """Add the parents that were valid at the event time of each reading.

    The sensor is the hash-join key and the validity interval a residual condition, so
    each reading meets only the versions of its own sensor; those of sensors with many
    versions are found by one scan over readings and versions.
    """
    known = versions.select(
        F.col("child").alias("identifier"), "parents", "valid_from", "valid_to"
    )

    def joined(readings: DataFrame, few: DataFrame) -> DataFrame:
        met = readings.join(sized(few, version_rows, broadcast_rows), "identifier")
        time = F.col("event_time")
        inside = (time >= F.col("valid_from")) & (
            F.col("valid_to").isNull() | (time < F.col("valid_to"))
        )
        return met.where(inside).drop("valid_from", "valid_to")

    return _few_and_many(measurements, known, broadcast_rows, joined, _versions_by_scan)


def _few_and_many(readings: DataFrame, known: DataFrame, broadcast_rows: int, few, many) -> DataFrame:
    """few(readings, known) of sensors with few rows in known, many(...) of the others."""
    busy = write_table(
        known.groupBy("identifier")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > MANY_VERSIONS)
        .select("identifier"),
        "busy",
    )
    rows = busy.count()
    if rows == 0:
        return few(readings, known)
    busy = sized(busy, rows, broadcast_rows)
    split = [
        [df.join(busy, "identifier", how) for df in (readings, known)]
        for how in ("left_anti", "left_semi")
    ]
    return few(*split[0]).unionByName(many(*split[1]))


def _versions_by_scan(readings: DataFrame, versions: DataFrame) -> DataFrame:
    """The version of each reading is the last one that began by its time."""
    order = (F.unix_micros("valid_from") * 2).alias("_order")
    begun = versions.where("valid_to IS NULL OR valid_to > valid_from").select(
        "identifier", order, F.struct(order, "parents", "valid_to").alias("_version")
    )
    asked = readings.select(
        "identifier",
        (F.unix_micros("event_time") * 2 + 1).alias("_order"),
        F.struct("*").alias("_reading"),
    )
    rows = write_table(begun.unionByName(asked, allowMissingColumns=True), "timeline")
    scanned = with_running(
        rows, ["identifier"], "_order", [Running("_known", "max", "_version")], _SCAN_BITS
    )
    ended = F.col("_known.valid_to") <= F.col("_reading.event_time")
    return (
        scanned.where(F.col("_reading").isNotNull() & F.col("_known").isNotNull())
        .where(~F.coalesce(ended, F.lit(False)))
        .select("_reading.*", F.col("_known.parents").alias("parents"))
    )


def _change_by_scan(readings: DataFrame, changes: DataFrame, once: bool) -> DataFrame:
    """Adds the next change to each reading; with once not one at the very time of it."""
    at_change, at_reading = (0, 1) if once else (1, 0)
    order = F.unix_micros("change_time") * 2 + at_change
    coming = changes.select(
        "identifier",
        (-order).alias("_back"),
        F.struct(order.alias("order"), "change_seq", "change_time").alias("_change"),
    )
    asked = readings.select(
        "identifier",
        (-(F.unix_micros("event_time") * 2 + at_reading)).alias("_back"),
        F.struct("*").alias("_reading"),
    )
    rows = write_table(coming.unionByName(asked, allowMissingColumns=True), "timeline")
    scanned = with_running(
        rows, ["identifier"], "_back", [Running("_next", "min", "_change")], _SCAN_BITS
    )
    return scanned.where(F.col("_reading").isNotNull() & F.col("_next").isNotNull()).select(
        "_reading.*", "_next.change_time", "_next.change_seq"
    )


def reattribute_on_change(
    measurements: DataFrame,
    changes: DataFrame,
    change_rows: int,
    broadcast_rows: int,
    once: bool = False,
) -> DataFrame:
    """The last reading of each sensor known when its parents changed.

    With ``once`` no parent gets a reading a second time: a reading at the very time of a
    change already goes to the new parents, and parents that stay have had the one before.

    Each reading falls into exactly one interval between two changes of its sensor, so
    one partial aggregate keeps the last reading per interval and even a sensor with a
    third of all rows is reduced before the shuffle. Carrying the value over intervals
    without readings then only touches the changes of a sensor. Changes of one sensor
    are ordered by their ``arrival_seq``, and so are their times.
    """
    intervals = with_previous(
        changes.select("child", "event_time", "arrival_seq"),
        ["child"],
        "arrival_seq",
        ["event_time"],
        "before",
    ).select(
        F.col("child").alias("identifier"),
        F.col("before.event_time").alias("after"),
        F.col("event_time").alias("change_time"),
        F.col("arrival_seq").alias("change_seq"),
    )
    order = packed_order(F.unix_micros("event_time"), F.col("arrival_seq"))
    time = F.col("event_time")
    if once:
        known_then, before_last = time < F.col("change_time"), time < F.col("after")
    else:
        known_then, before_last = time <= F.col("change_time"), time <= F.col("after")
    parents = F.col("parents")
    if once:
        old = F.coalesce("old_parents", F.array().cast("array<string>"))
        parents = F.array_except("parents", old)
    def joined(readings: DataFrame, few: DataFrame) -> DataFrame:
        met = readings.join(sized(few, change_rows, broadcast_rows), "identifier")
        return met.where(known_then & (F.col("after").isNull() | ~before_last)).drop("after")

    def scanned(readings: DataFrame, many: DataFrame) -> DataFrame:
        return _change_by_scan(readings, many, once)

    last = (
        _few_and_many(measurements, intervals, broadcast_rows, joined, scanned)
        .groupBy("identifier", "change_time", "change_seq")
        .agg(
            F.max_by("value_w", order).alias("value_w"),
            F.max_by("payload_ts_ms", order).alias("payload_ts_ms"),
            F.max_by("arrival_seq", order).alias("arrival_seq"),
        )
    )
    known = changes.select(
        F.col("child").alias("identifier"),
        "op",
        parents.alias("parents"),
        F.col("event_time").alias("change_time"),
        F.col("arrival_seq").alias("change_seq"),
    ).join(last, ["identifier", "change_time", "change_seq"], "left")
    # One row per change: written, because the running scan below reads it twice.
    known = write_table(known, "known")
    reading = F.struct("change_seq", "value_w", "payload_ts_ms", "arrival_seq")
    carried = with_running(
        known.withColumn("reading", F.when(F.col("value_w").isNotNull(), reading)),
        ["identifier"],
        "change_seq",
        [Running("newest", "max", "reading")],
    )
    return carried.where("op = 'upsert' AND newest IS NOT NULL").select(
        "identifier",
        "parents",
        "change_time",
        "change_seq",
        "newest.value_w",
        "newest.payload_ts_ms",
        "newest.arrival_seq",
    )


def contributions_over_time(
    measurements: DataFrame, changes: DataFrame, change_rows: int, cfg: RollupConfig
) -> DataFrame:
    """Readings per parent under a changing membership.

    A reading goes to the parents of its event time. At a change the sensor's last
    reading also goes, at the time of the change, to its new parents; where readings add
    up, to those that are new to it. Under "retract"
    what a pair (sensor, former parent) had contributed before the change to the window
    of the change is dropped; earlier windows stay as they are.
    """
    columns = ["identifier", "parent", "event_time", "payload_ts_ms", "value_w", "arrival_seq"]
    direct = fan_out(
        join_parents_as_of(
            measurements, versioned_edges(changes), change_rows, cfg.broadcast_rows
        )
    ).select(*columns)
    adds_up = cfg.child_agg in ("sum", "avg")
    moved = fan_out(
        reattribute_on_change(
            measurements, changes, change_rows, cfg.broadcast_rows, once=adds_up
        )
    ).withColumn("event_time", F.col("change_time"))
    rows = direct.unionByName(moved.select(*columns))
    if cfg.on_removal == "ignore":
        return rows
    removed = with_window_start(membership_retractions(changes), cfg)
    last_removal = removed.groupBy(
        F.col("child").alias("identifier"), "parent", "window_start"
    ).agg(F.max("event_time").alias("removed_at"))
    kept = F.col("removed_at").isNull() | (F.col("event_time") >= F.col("removed_at"))
    return (
        with_window_start(rows, cfg)
        .join(
            sized(last_removal, change_rows, cfg.broadcast_rows),
            ["identifier", "parent", "window_start"],
            "left",
        )
        .where(kept)
        .select(*columns)
    )
