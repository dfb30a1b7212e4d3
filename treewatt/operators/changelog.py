"""Every update of every group's result, in arrival order."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import result_columns
from treewatt.functions.exact import BinaryParts, ScaledParts, parts_for
from treewatt.functions.running import HotBucket, Running, with_running
from treewatt.functions.tables import sized, write_table
from treewatt.operators.hierarchy import Hierarchy
from treewatt.operators.rollup import leaf_only


Parts = ScaledParts | BinaryParts


def _names(kind: str, parts: Parts) -> list[str]:
    return [f"{kind}_{i}" for i in range(parts.count)]


def child_deltas(offers: DataFrame, parts: Parts, child_agg: str = "last") -> DataFrame:
    """What each update of a child changes in its window.

    ``offers`` are updates ``(window_start, identifier, arrival_seq, payload_ts_ms, units_0, ...,
    from_children)`` and whatever else should come along; it is read twice, so hand in a written
    table. Adds ``delta_0, ...`` (the new value minus the one before, by parts) and ``is_first``
    (the child had no value in this window before).

    With "last" the new value replaces the one before, unless it is older than that; the other
    aggregates take in all values so far, of which an offer may stand for several (``readings``).
    """
    units, deltas = _names("units", parts), _names("delta", parts)
    keys = ["window_start", "identifier"]
    none = F.lit(0).cast("bigint")
    if child_agg == "last":
        before = with_running(
            offers.withColumn(
                "offer", F.struct("payload_ts_ms", "from_children", "arrival_seq", *units)
            ),
            keys,
            "arrival_seq",
            [Running("replaced", "max", "offer", before=True)],
        )
        first = F.col("replaced").isNull()
        replaces = first | (F.col("offer") > F.col("replaced"))
        old = [F.coalesce(f"replaced.{u}", none) for u in units]
        new = [F.when(replaces, F.col(u)).otherwise(o) for u, o in zip(units, old, strict=True)]
    elif child_agg in ("max", "min"):
        # Parts of a value compare like the value from the highest one down.
        value = F.struct(*reversed(units))
        before = with_running(
            offers.withColumn("offer", value),
            keys,
            "arrival_seq",
            [Running("best", child_agg, "offer", before=True)],
        )
        first = F.col("best").isNull()
        offer, best = F.col("offer"), F.col("best")
        better = first | (offer > best if child_agg == "max" else offer < best)
        old = [F.coalesce(f"best.{u}", none) for u in units]
        new = [F.when(better, F.col(u)).otherwise(o) for u, o in zip(units, old, strict=True)]
    else:
        sums = [Running(f"sum_{u}", "sum", u, before=True) for u in units]
        times = Running("times", "sum", "readings", before=True)
        before = with_running(offers, keys, "arrival_seq", [*sums, times])
        first = F.col("times").isNull()
        old = [F.coalesce(r.name, none) for r in sums]
        new = [F.col(u) + o for u, o in zip(units, old, strict=True)]
        if child_agg == "avg":
            new = parts.average(new, F.coalesce("times", none) + F.col("readings"))
            average = parts.average(old, F.col("times"))
            old = [F.when(first, none).otherwise(a) for a in average]
    changed = [(n - o).alias(d) for n, o, d in zip(new, old, deltas, strict=True)]
    return before.select(*offers.columns, *changed, first.alias("is_first"))


def _offers(accepted: DataFrame, parts: Parts) -> DataFrame:
    readings = F.col("readings") if "readings" in accepted.columns else F.lit(1).cast("bigint")
    return accepted.select(
        "window_start",
        "identifier",
        "arrival_seq",
        "payload_ts_ms",
        *[u.alias(n) for u, n in zip(parts.split(F.col("value_w")), _names("units", parts), strict=True)],
        readings.alias("readings"),
        F.lit(False).alias("from_children"),
        "event_time",
        *_stream_time(accepted),
    )


def _stream_time(df: DataFrame) -> list[str]:
    return ["stream_time"] if "stream_time" in df.columns else []


def running_results(
    updates: DataFrame, node: str, parts: int = 1, hot: list[HotBucket] | None = None
) -> DataFrame:
    """Counts, sums (total_0, ...) and newest times after each update of a group; ``hot`` as in
    ``with_running``."""
    return with_running(
        updates,
        ["window_start", node],
        "arrival_seq",
        [
            Running("n", "sum", "joins"),
            *[Running(f"total_{i}", "sum", f"moves_{i}") for i in range(parts)],
            Running("newest", "max", "payload_ts_ms"),
            Running("event_time", "max", "record_time"),
        ],
        hot=hot,
    )


def aggregate_changelog(
    accepted: DataFrame, hierarchy: Hierarchy, cfg: RollupConfig
) -> DataFrame:
    """One result row per accepted reading and group above its sensor.

    Rows carry ``arrival_seq`` of the reading that caused them, ``event_time`` (the
    newest record time that went into the result) and, if the input has it,
    ``stream_time``. Only states after an update are rows; the step in between, with the
    old value taken out and the new one not yet added, never shows. Readings must come
    from leaves (else see ``changelog_by_height``), each with its own ``arrival_seq``;
    ``window_start`` must be present. ``accepted`` is read twice, and once more without
    ``sum_scale``: sums are exact in either case, see ``functions.exact``. Rows have the
    window's bounds also under ``drop_window``, as what follows tells groups apart by them; see
    ``public_columns``.
    """
    parts = parts_for(accepted, "value_w", cfg)
    deltas = write_table(child_deltas(_offers(accepted, parts), parts, cfg.child_agg), "deltas")
    closure = hierarchy.sized_closure().withColumnRenamed("leaf", "identifier")
    spread = deltas.join(closure, "identifier").withColumn("delta_0", leaf_only("delta_0"))

    # The first reading below a direct child adds one to the count.
    firsts = (
        spread.where("is_first")
        .groupBy("window_start", "ancestor", "via_child")
        .agg(F.min("arrival_seq").alias("arrival_seq"))
        .groupBy("window_start", "ancestor", "arrival_seq")
        .agg(F.count("*").alias("joins"))
    )
    moved = spread.groupBy("window_start", "ancestor", "arrival_seq").agg(
        *[
            F.sum(F.col(d) * F.col("paths")).alias(m)
            for d, m in zip(_names("delta", parts), _names("moves", parts), strict=True)
        ],
        F.max("payload_ts_ms").alias("payload_ts_ms"),
        F.max("event_time").alias("record_time"),
        *[F.max(c).alias(c) for c in _stream_time(accepted)],
    )
    updates = write_table(
        moved.join(firsts, ["window_start", "ancestor", "arrival_seq"], "left").withColumn(
            "joins", F.coalesce("joins", F.lit(0))
        ),
        "updates",
    )
    extra = ("event_time", "arrival_seq", *_stream_time(accepted))
    totals = [F.col(t) for t in _names("total", parts)]
    results = running_results(updates, "ancestor", parts.count).withColumn(
        "total", parts.total(totals)
    )
    return results.select(
        *result_columns(replace(cfg, drop_window=False), "ancestor", "n", "total", "newest", extra)
    )


def public_columns(results: DataFrame, cfg: RollupConfig) -> DataFrame:
    """Without the bounds of the window, if results are to be without them."""
    return results.drop("window_start", "window_end") if cfg.drop_window else results


def only_last_values(cfg: RollupConfig) -> None:
    if cfg.child_agg != "last":
        raise ValueError("groups that report, or move, have last values: child_agg must be 'last'")
    if cfg.sum_scale is None:
        raise ValueError("going by height adds and subtracts: set sum_scale, for exact sums")


def changelog_by_height(
    accepted: DataFrame, hierarchy: Hierarchy, cfg: RollupConfig
) -> DataFrame:
    """The changelog when groups may report themselves as well.

    Goes up the tree one height at a time: the updates of all children of a group are
    known before the group's own results are derived, and a group's value is whichever
    is newer, its own reading or the sum of its children (the sum on a tie). Rows as in
    ``aggregate_changelog``; a reading causes one row per group it reaches.
    """
    only_last_values(cfg)
    stream_time = _stream_time(accepted)
    heights = sized(
        hierarchy.nodes.select(F.col("child").alias("identifier"), "height"),
        hierarchy.edge_rows,
        hierarchy.broadcast_rows,
    )
    parts = ScaledParts(cfg)
    own = write_table(
        _offers(accepted, parts).drop("readings").join(heights, "identifier"), "own"
    )
    deltas: list[DataFrame] = []
    results: list[DataFrame] = []
    extra = ("event_time", "arrival_seq", *stream_time)

    for height in range(hierarchy.height + 1):
        offers = own.where(F.col("height") == height).drop("height")
        if height > 0:
            arriving = reduce(
                DataFrame.unionByName,
                [d.where(F.col("parent_height") == height) for d in deltas],
            )
            updates = write_table(
                arriving.groupBy("window_start", "parent", "arrival_seq").agg(
                    F.sum(F.col("is_first").cast("bigint")).alias("joins"),
                    F.sum("delta_0").alias("moves_0"),
                    F.max("payload_ts_ms").alias("payload_ts_ms"),
                    F.max("event_time").alias("record_time"),
                    *[F.max(c).alias(c) for c in stream_time],
                ),
                "updates",
            )
            after = write_table(running_results(updates, "parent"), "results")
            results.append(
                after.select(
                    *result_columns(
                        replace(cfg, drop_window=False), "parent", "n", "total_0", "newest", extra
                    )
                )
            )
            offers = offers.unionByName(
                after.select(
                    "window_start",
                    F.col("parent").alias("identifier"),
                    "arrival_seq",
                    F.col("newest").alias("payload_ts_ms"),
                    F.col("total_0").alias("units_0"),
                    F.lit(True).alias("from_children"),
                    "event_time",
                    *stream_time,
                )
            )
        if height < hierarchy.height:
            links = sized(
                hierarchy.links.where(F.col("height") == height).select(
                    F.col("child").alias("identifier"), "parent", "parent_height"
                ),
                hierarchy.edge_rows,
                hierarchy.broadcast_rows,
            )
            deltas.append(
                write_table(
                    child_deltas(write_table(offers, "offers"), parts).join(links, "identifier"),
                    "deltas",
                )
            )
    return reduce(DataFrame.unionByName, results)
