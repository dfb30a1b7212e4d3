"""Roll-ups: one level, level by level, and through the closure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import (
    result_columns,
    child_units,
)
from treewatt.functions.tables import sized
from treewatt.operators.hierarchy import Hierarchy
from treewatt.operators.latest import value_per_window


def results_as_measurements(results: DataFrame) -> DataFrame:
    """A result read as a reading of its own group: the sum is the value."""
    return results.select(
        "identifier",
        "event_time",
        F.col("timestamp_ms").alias("payload_ts_ms"),
        F.col("sum_w").alias("value_w"),
    )


def aggregate_children(values: DataFrame, cfg: RollupConfig) -> DataFrame:
    """Results per window and parent from one value per child: ``(window_start, parent,
    identifier, payload_ts_ms, value_w, event_time)``."""
    return (
        values.groupBy("window_start", "parent")
        .agg(
            F.count("*").alias("n"),
            F.sum(child_units(F.col("value_w"), cfg)).alias("total"),
            F.max("payload_ts_ms").alias("newest"),
            F.max("event_time").alias("event_time"),
        )
        .select(*result_columns(cfg, "parent", "n", "total", "newest"))
    )


def rollup_one_level(
    measurements: DataFrame,
    edges: DataFrame,
    edge_rows: int,
    cfg: RollupConfig,
) -> DataFrame:
    """Count, sum, average and newest time of the direct children per window.

    Readings are reduced to one row per window and sensor before the join, so neither
    the join nor its shuffle sees the raw volume or a hot sensor.
    """
    parents = sized(
        edges.select(F.col("child").alias("identifier"), "parent"), edge_rows, cfg.broadcast_rows
    )
    return aggregate_children(value_per_window(measurements, cfg).join(parents, "identifier"), cfg)


def rollup_multilevel(
    measurements: DataFrame, hierarchy: Hierarchy, cfg: RollupConfig
) -> DataFrame:
    """Results of every group at every level, bottom-up.

    A group that also reports itself is worth whichever is newer, its own reading or the
    sum of its children; the sum wins a tie.
    """
    return rollup_values(value_per_window(measurements, cfg), hierarchy, cfg)


def rollup_values(values: DataFrame, hierarchy: Hierarchy, cfg: RollupConfig) -> DataFrame:
    """Bottom-up roll-up of one value per window and node.

    One aggregate per height. All leaves, however deep they hang, are folded into their
    parents by the first one; from then on only groups are left. Finished groups ride
    along as result rows, so the plan is one chain that reads its input once.
    """
    nodes = hierarchy.sized_nodes().withColumnRenamed("child", "identifier")
    units = child_units(F.col("value_w"), cfg)

    # Leaves go to their parents; a reading of a group itself waits for its children.
    placed = values.join(nodes, "identifier").withColumn("is_leaf", F.col("height") == 0)
    first = placed.select(
        "window_start",
        F.explode(
            F.when(F.col("is_leaf"), F.col("parents")).otherwise(F.array("identifier"))
        ).alias("node"),
        F.lit(False).alias("done"),
        F.when(F.col("is_leaf"), 1).otherwise(0).cast("bigint").alias("n"),
        F.when(F.col("is_leaf"), units).alias("total"),
        F.when(F.col("is_leaf"), F.col("payload_ts_ms")).alias("newest"),
        F.when(~F.col("is_leaf"), units).alias("own"),
        F.when(~F.col("is_leaf"), F.col("payload_ts_ms")).alias("own_ts"),
        F.when(F.col("is_leaf"), F.col("event_time")).alias("event_time"),
        F.when(~F.col("is_leaf"), F.col("event_time")).alias("own_time"),
    )
    return _climb(_fold(first), hierarchy, range(1, hierarchy.height), cfg)


def rollup_memberships(values: DataFrame, groups: Hierarchy | None, cfg: RollupConfig) -> DataFrame:
    """Bottom-up roll-up of one value per window, sensor and parent.

    The sensors' parents come with the rows; ``groups`` is the hierarchy of the parents
    among themselves, none if there is just one level.
    """
    if groups is None:
        return aggregate_children(values, cfg)
    nothing_own = _nothing_own(cfg)
    first = values.select(
        "window_start",
        F.col("parent").alias("node"),
        F.lit(False).alias("done"),
        F.lit(1).cast("bigint").alias("n"),
        child_units(F.col("value_w"), cfg).alias("total"),
        F.col("payload_ts_ms").alias("newest"),
        *nothing_own[:2],
        "event_time",
        nothing_own[2],
    )
    return _climb(_fold(first), groups, range(groups.height), cfg)


def _nothing_own(cfg: RollupConfig) -> list[Column]:
    return [
        F.lit(None).cast("double" if cfg.sum_scale is None else "bigint").alias("own"),
        F.lit(None).cast("bigint").alias("own_ts"),
        F.lit(None).cast("timestamp").alias("own_time"),
    ]


def _climb(
    state: DataFrame, hierarchy: Hierarchy, heights: range, cfg: RollupConfig
) -> DataFrame:
    """Finish the groups of one height after the other and pass their values up.

    Only nodes of the current height match the join; finished results are of lower
    heights and pass through.
    """
    nothing_own = _nothing_own(cfg)
    for height in heights:
        nodes = hierarchy.sized_nodes(height).select(F.col("child").alias("node"), "parents")
        joined = state.join(nodes, "node", "left")
        ready = F.col("parents").isNotNull()
        has_children = F.col("n") > 0
        children_win = has_children & (
            F.col("own_ts").isNull() | (F.col("newest") >= F.col("own_ts"))
        )
        as_is = F.struct(
            "node", "done", "n", "total", "newest", "own", "own_ts", "event_time", "own_time"
        )
        finished = F.struct(
            "node",
            F.lit(True).alias("done"),
            "n",
            "total",
            "newest",
            *nothing_own[:2],
            "event_time",
            nothing_own[2],
        )
        value = F.when(children_win, F.col("total")).otherwise(F.col("own"))
        value_ts = F.when(children_win, F.col("newest")).otherwise(F.col("own_ts"))
        value_time = F.when(children_win, F.col("event_time")).otherwise(F.col("own_time"))

        def for_parent(parent: Column) -> Column:
            return F.struct(
                parent.alias("node"),
                F.lit(False).alias("done"),
                F.lit(1).cast("bigint").alias("n"),
                value.alias("total"),
                value_ts.alias("newest"),
                *nothing_own[:2],
                value_time.alias("event_time"),
                nothing_own[2],
            )

        to_parents = F.transform("parents", for_parent)
        rows = (
            F.when(~ready, F.array(as_is))
            .when(has_children, F.concat(to_parents, F.array(finished)))
            .otherwise(to_parents)
        )
        state = _fold(joined.select("window_start", F.inline(rows)))

    return state.where("n > 0").select(*result_columns(cfg, "node", "n", "total", "newest"))


def _fold(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start", "node", "done").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.max("newest").alias("newest"),
        # At most one row per window and node carries the node's own reading.
        F.max("own").alias("own"),
        F.max("own_ts").alias("own_ts"),
        F.max("event_time").alias("event_time"),
        F.max("own_time").alias("own_time"),
    )


def rollup_closure(
    measurements: DataFrame, hierarchy: Hierarchy, cfg: RollupConfig
) -> DataFrame:
    """Results of every group through (leaf, ancestor, via child), without iteration.

    The number of shuffles does not depend on the depth. Valid when only leaves report;
    a reading of a group itself raises, because its children's sum may be older or newer.
    """
    return closure_results(closure_values(value_per_window(measurements, cfg), hierarchy), cfg)


def leaf_only(column: str) -> Column:
    """A column of closure rows, raising where the reporting node has children."""
    refused = F.raise_error(
        F.concat(F.lit("a group reports itself, go level by level: "), F.col("identifier"))
    )
    return F.coalesce(F.when(F.col("inner"), refused), F.col(column))


def closure_values(values: DataFrame, hierarchy: Hierarchy) -> DataFrame:
    """One row per window, leaf and ancestor path."""
    closure = hierarchy.sized_closure().withColumnRenamed("leaf", "identifier")
    return values.join(closure, "identifier").withColumn("value_w", leaf_only("value_w"))


def closure_results(values: DataFrame, cfg: RollupConfig) -> DataFrame:
    """Two aggregates: per direct child first, then per group.

    The first spreads a hot root over its direct children, so the second shuffles one
    row per (window, group, direct child) at most.
    """
    per_child = values.groupBy("window_start", "ancestor", "via_child").agg(
        F.sum(child_units(F.col("value_w"), cfg) * F.col("paths")).alias("total"),
        F.max("payload_ts_ms").alias("newest"),
        F.max("event_time").alias("event_time"),
    )
    return (
        per_child.groupBy("window_start", "ancestor")
        .agg(
            F.count("*").alias("n"),
            F.sum("total").alias("total"),
            F.max("newest").alias("newest"),
            F.max("event_time").alias("event_time"),
        )
        .select(*result_columns(cfg, "ancestor", "n", "total", "newest"))
    )
