"""Batch pipelines: from readings and a hierarchy to results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig, require
from treewatt.functions.tables import write_table
from treewatt.operators.attribution import contributions_over_time
from treewatt.operators.changelog import (
    aggregate_changelog,
    changelog_by_height,
    public_columns,
)
from treewatt.operators.hierarchy import Hierarchy, build_hierarchy
from treewatt.operators.latest import value_per_window
from treewatt.operators.late import (
    accepted_with_stream_time,
    drop_late,
    unique_arrival,
    with_release_time,
)
from treewatt.operators.members import follow_members, no_state, results_of
from treewatt.operators.registry import (
    changes_after,
    current_parents,
    diff_history,
    flatten_registry,
    snapshot_events,
    unique_identifiers,
)
from treewatt.operators.rollup import (
    rollup_closure,
    rollup_memberships,
    rollup_multilevel,
)
from treewatt.operators.throttle import throttle, throttled_emission

EMISSIONS = ("final", "closure", "changelog", "throttled")


def build_batch(
    measurements: DataFrame,
    hierarchy: Hierarchy,
    cfg: RollupConfig,
    emission: str = "final",
    by: tuple[str, ...] = (),
    groups_report: bool = False,
) -> DataFrame:
    """Results of all groups at all levels over stored readings.

    emission   "final": one result per window and group after all accepted readings;
               "closure": the same without iteration, when only leaves report;
               "changelog": every update; "throttled": rate-limited updates
    by         columns that name the source whose clock decides lateness; arrival numbers
               are then unique within a source only, and changelogs carry new ones. Entries
               of throttled results are released by the time that all sources have reached,
               which is their ``stream_time`` then
    groups_report   whether groups may send readings of their own; "changelog" and
               "throttled" then go level by level ("final" always does)
    """
    require(measurements=measurements, hierarchy=hierarchy, cfg=cfg)
    if emission == "final":
        return rollup_multilevel(drop_late(measurements, cfg, by), hierarchy, cfg)
    if emission == "closure":
        return rollup_closure(drop_late(measurements, cfg, by), hierarchy, cfg)
    if emission not in EMISSIONS:
        raise ValueError(f"emission must be one of {EMISSIONS}")
    arrived = unique_arrival(measurements, by)
    if emission == "throttled" and by:
        arrived = write_table(arrived, "arrived")
        arrived = write_table(with_release_time(arrived, by), "released")
    accepted = accepted_with_stream_time(arrived, cfg, by)
    if emission == "throttled" and by:
        accepted = accepted.withColumn("stream_time", F.col("release_time"))
    follow = changelog_by_height if groups_report else aggregate_changelog
    changelog = follow(write_table(accepted, "accepted"), hierarchy, cfg)
    if emission == "throttled" and by:
        end = arrived.agg(F.unix_micros(F.max("release_time"))).first()[0]
        changelog = throttle(changelog, end, cfg)[0]
    elif emission == "throttled":
        changelog = throttled_emission(changelog, measurements, cfg)
    return public_columns(changelog, cfg)


def hierarchy_from_events(events: DataFrame, cfg: RollupConfig) -> Hierarchy:
    """The hierarchy known after all registry events.

    Events with a ``source_partition`` are numbered by their partitions; snapshots take turns
    by these numbers.
    """
    snapshots = snapshot_events(events)
    if "source_partition" in snapshots.columns:
        snapshots = unique_arrival(write_table(snapshots, "snapshots"), ("source_partition",))
    edges = unique_identifiers(flatten_registry(snapshots), "arrival_seq")
    known = current_parents(diff_history(edges, snapshots))
    return build_hierarchy(
        known.selectExpr("child", "explode(parents) AS parent"),
        broadcast_rows=cfg.broadcast_rows,
    )


def rollup_members(
    measurements: DataFrame, events: DataFrame, cfg: RollupConfig, emission: str = "changelog"
) -> DataFrame:
    """Results while nodes of any level join, move and leave, in the order of arrival.

    Readings and registry events share one order of arrival numbers; see
    ``operators.members`` for what a change does, and ``streaming.members`` for the same on a
    stream. emission is "final", "changelog" or "throttled".
    """
    require(measurements=measurements, events=events, cfg=cfg)
    if emission not in ("final", "changelog", "throttled"):
        raise ValueError("emission must be final, changelog or throttled")
    spark = measurements.sparkSession
    state = no_state(spark)
    snapshots = write_table(
        snapshot_events(events).select("arrival_seq", "event_time", "payload"), "snapshots"
    )
    changes = changes_after(state.parents, snapshots)
    log, after = follow_members(measurements, changes, state, cfg, last_call=True)
    if emission == "final":
        return results_of(after.groups, cfg)
    if emission == "throttled":
        log = throttle(log, after.clock, cfg)[0]
    return public_columns(log, cfg)


def rollup_changing_membership(
    measurements: DataFrame,
    changes: DataFrame,
    change_rows: int,
    groups: Hierarchy | None,
    cfg: RollupConfig,
) -> DataFrame:
    """Results under sensors that join, move and leave while the groups stay.

    ``changes`` is the change history of the sensors (see ``diff_history``), ``groups``
    the fixed hierarchy above their direct parents.
    """
    rows = contributions_over_time(drop_late(measurements, cfg), changes, change_rows, cfg)
    values = value_per_window(rows, cfg, ("identifier", "parent"))
    return rollup_memberships(values, groups, cfg)
