"""Results under memberships that change at any level, in the order of arrival.

Readings and changes of the registry share one order of arrival, and each row meets what had
arrived before it:

* A reading goes to the parents that its sensor has when it arrives, and so does every result
  of a group: groups move like any other child.
* When the parents of a node change, its last update (the one that arrived last, late or not)
  goes to all its new parents again, in the window of the change or of the update, whichever is
  later. That is also how a reading from before its sensor was known comes to count.
* Under "retract" the parents that it leaves lose its value in that window. Other windows stay.
* A group that has lost all children has a result with count 0, and its own parents lose it.

Updates of one arrival that reach a group in one window are one result, whatever their number;
of one node, what a change moves comes before what the same arrival makes of it.

Everything is a call over carried tables: stored input is one call from the empty state, a
stream one call a micro-batch, and both give the same rows. Only leaves may report, and the
edges of one call, old and new ones together, must not form a cycle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import result_columns, summable, window_end, window_length
from treewatt.functions.running import Running, hot_buckets, with_running
from treewatt.functions.tables import sized, write_table
from treewatt.operators.changelog import only_last_values, running_results
from treewatt.operators.hierarchy import Hierarchy, build_hierarchy
from treewatt.operators.late import with_stream_time

# The order of what earlier calls left, before all arrivals of this one.
_BEFORE = -(2**62)

# Carried tables: their columns, and the key of a row.
WHOLE_TABLES = {
    "parents": "child string, parents array<string>",
    "edges": "child string, parent string, until bigint",
}
KEYED_TABLES = {
    "last": (
        "node string, window_start timestamp, payload_ts_ms bigint, units bigint, "
        "event_time timestamp, gone boolean",
        ("node",),
    ),
    "pairs": (
        "window_start timestamp, child string, parent string, payload_ts_ms bigint, units bigint",
        ("window_start", "child", "parent"),
    ),
    "groups": (
        "window_start timestamp, node string, n bigint, total bigint, newest bigint, "
        "event_time timestamp",
        ("window_start", "node"),
    ),
}
_UPDATE = ["window_start", "payload_ts_ms", "units", "event_time", "gone"]
_PAIR = ["window_start", "child", "parent"]


class Carried:
    """Rows of a keyed table, by the keys that are asked for."""

    def __init__(self, rows: DataFrame, keys: tuple[str, ...]):
        self.rows, self.keys = rows, list(keys)

    def of(self, asked: DataFrame) -> DataFrame:
        return self.rows.join(asked.select(*self.keys).distinct(), self.keys, "left_semi")

    def whole(self) -> DataFrame:
        return self.rows

    def after(self, changed: DataFrame) -> Carried:
        """With the rows of changed in place of those of equal key, but for removed ones."""
        kept = self.rows.join(changed.select(*self.keys), self.keys, "left_anti")
        new = changed.where("NOT removed").drop("removed")
        return Carried(write_table(kept.unionByName(new), "carried"), tuple(self.keys))


@dataclass(frozen=True)
class MemberState:
    """What one call leaves to the next, beyond any window.

    clock     stream time in microseconds
    parents   the parents of each node now
    edges     former edges, as long as a window may hold a value over them
    last      the last update of each node, sensor or group, known to the registry or not
    pairs     per window, what each child is worth to each parent
    groups    per window, the running result of each group

    Of the last three a call reads the rows that its own touch, and leaves them changed with a
    column ``removed``; all others stay as they are.
    """

    clock: int | None
    parents: DataFrame
    edges: DataFrame
    last: Carried | DataFrame
    pairs: Carried | DataFrame
    groups: Carried | DataFrame

    def after(self, changed: MemberState) -> MemberState:
        """The state with what a call has changed."""
        keyed = {name: getattr(self, name).after(getattr(changed, name)) for name in KEYED_TABLES}
        return replace(changed, **keyed)


def _nothing(spark: SparkSession, schema: str) -> DataFrame:
    """A table that the optimiser knows to be empty, so that joins with it cost nothing."""
    return spark.createDataFrame([], schema).limit(0)


def no_state(spark: SparkSession) -> MemberState:
    whole = {name: _nothing(spark, schema) for name, schema in WHOLE_TABLES.items()}
    keyed = {
        name: Carried(_nothing(spark, schema), keys)
        for name, (schema, keys) in KEYED_TABLES.items()
    }
    return MemberState(None, **whole, **keyed)


def is_open(clock: int | None, cfg: RollupConfig) -> Column:
    """Whether stream time has not closed the window of a row yet."""
    return F.lit(True) if clock is None else _open_until(cfg) > F.lit(clock).cast("bigint")


def _open_until(cfg: RollupConfig) -> Column:
    return F.unix_micros(window_end(cfg)) + F.lit(cfg.grace_period_ms * 1000)


def _window_of(time: Column, cfg: RollupConfig) -> Column:
    return F.window(time, window_length(cfg))["start"]


def _window_at(time: Column, cfg: RollupConfig) -> Column:
    """As _window_of, but null for rows without a time, which that leaves out."""
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(cfg.emit_period_ms * 1000)))


def follow_members(
    readings: DataFrame,
    changes: DataFrame,
    state: MemberState,
    cfg: RollupConfig,
    last_call: bool = False,
) -> tuple[DataFrame, MemberState]:
    """The changelog of all groups, and what it changes of the state; without last updates, which
    only another call needs, in the last call.

    ``changes`` are rows ``(child, old_parents, parents, arrival_seq, event_time)`` as
    ``diff_history`` gives them; those of one snapshot share its arrival number, which no
    reading has. Changelog rows are those of ``aggregate_changelog``.
    """
    only_last_values(cfg)
    nobody = F.array().cast("array<string>")
    changes = write_table(
        changes.select(
            F.col("child").alias("node"),
            F.coalesce("old_parents", nobody).alias("old_parents"),
            F.coalesce("parents", nobody).alias("parents"),
            "arrival_seq",
            "event_time",
        ),
        "changes",
    )
    arrivals = _arrivals(readings, changes, state.clock, cfg)
    seen = arrivals.agg(
        F.unix_micros(F.max("stream_time")).alias("newest"), F.min("arrival_seq").alias("first")
    ).first()
    clock = seen.newest if seen.newest is not None else state.clock
    tree = _tree(changes, state, cfg)
    stamps = arrivals.where("identifier IS NULL").select("arrival_seq", "stream_time")
    settled = _settled(changes, state.parents)
    call = _Call(state, tree, cfg, changes, stamps, settled, seen.first, last_call)

    updates = call.readings(arrivals)
    last = [updates]
    deltas: list[_Deltas] = []
    pairs: list[DataFrame] = []
    groups: list[DataFrame] = []
    logs: list[DataFrame] = []
    for height in range(tree.height + 1):
        if height > 0:
            after, updates, now = call.results(deltas, height)
            logs.append(after)
            groups.append(now)
            last.append(updates)
        if height < tree.height:
            made, kept = call.deltas(updates, height)
            deltas.append(made)
            pairs.append(kept)

    def all_of(frames: list[DataFrame], name: str) -> DataFrame:
        """Read off written tables when asked for: stored input needs the groups at most."""
        return reduce(
            DataFrame.unionByName,
            frames,
            _nothing(readings.sparkSession, f"{KEYED_TABLES[name][0]}, removed boolean"),
        )

    after = MemberState(
        clock,
        call.settled.where(F.col("since").isNull() | (F.size("parents") > 0)).select(
            F.col("node").alias("child"), "parents"
        ),
        _edges_after(call.changes, state.edges, clock, cfg),
        all_of([] if last_call else [_last_of(last, cfg)], "last"),
        all_of(pairs, "pairs"),
        all_of(groups, "groups"),
    )
    if not logs:
        logs = [call.log_of(readings.sparkSession.createDataFrame([], _RESULT_STATE))]
    return reduce(DataFrame.unionByName, logs), after


_RESULT_STATE = (
    "window_start timestamp, node string, n bigint, total bigint, newest bigint, "
    "event_time timestamp, arrival_seq bigint, stream_time timestamp"
)


def _arrivals(
    readings: DataFrame, changes: DataFrame, clock: int | None, cfg: RollupConfig
) -> DataFrame:
    """Readings and one row per arrival of changes (identifier null), with stream time."""
    rows = readings.where(F.col("identifier").isNotNull()).select(
        "identifier",
        "event_time",
        "payload_ts_ms",
        summable(F.col("value_w"), cfg).alias("units"),
        "arrival_seq",
    )
    stamps = changes.select("arrival_seq", "event_time").distinct()
    rows = write_table(rows.unionByName(stamps, allowMissingColumns=True), "rows")
    carried = F.timestamp_micros(F.lit(clock).cast("bigint"))
    timed = with_stream_time(rows).withColumn("stream_time", F.greatest("stream_time", carried))
    return write_table(timed, "arrivals")


def _tree(changes: DataFrame, state: MemberState, cfg: RollupConfig) -> Hierarchy:
    """All edges that this call can meet; their heights say what comes first."""
    known = state.parents.selectExpr("child", "explode(parents) AS parent")
    edges = (
        known.unionByName(changes.selectExpr("node AS child", "explode(old_parents) AS parent"))
        .unionByName(changes.selectExpr("node AS child", "explode(parents) AS parent"))
        .unionByName(state.edges.select("child", "parent"))
    )
    return build_hierarchy(edges, broadcast_rows=cfg.broadcast_rows)


def _settled(changes: DataFrame, known: DataFrame) -> DataFrame:
    """The parents of each node after all changes, and since which arrival it has them; null if
    no change of this call names the node."""
    newest = changes.where("arrival_seq IS NOT NULL").groupBy("node").agg(
        F.max_by("parents", "arrival_seq").alias("parents"), F.max("arrival_seq").alias("since")
    )
    kept = known.withColumnRenamed("child", "node").join(
        newest.select("node"), "node", "left_anti"
    )
    return newest.unionByName(kept, allowMissingColumns=True)


def _edges_after(
    changes: DataFrame, known: DataFrame, clock: int | None, cfg: RollupConfig
) -> DataFrame:
    """Edges that are gone, until the last window that was open then has closed."""
    if clock is None:
        return known
    period = cfg.emit_period_ms * 1000
    until = (clock // period + 1) * period + cfg.grace_period_ms * 1000
    gone = changes.select(
        F.col("node").alias("child"),
        F.explode(F.array_except("old_parents", "parents")).alias("parent"),
        F.lit(until).cast("bigint").alias("until"),
    )
    both = known.where(F.col("until") > clock).unionByName(gone)
    return both.groupBy("child", "parent").agg(F.max("until").alias("until"))


def _last_of(updates: list[DataFrame], cfg: RollupConfig) -> DataFrame:
    """The last update of each node that has one in this call.

    The newest arrivals come first, as numbers, which a hash aggregate holds; only the updates of
    those arrivals are compared as structs, which would sort all of them.
    """
    merged = reduce(
        DataFrame.unionByName, [u.select("node", "arrival_seq", *_UPDATE) for u in updates]
    )
    newest = write_table(
        merged.groupBy("node").agg(F.max("arrival_seq").alias("newest_seq")), "newest"
    ).withColumnRenamed("node", "newest_node")
    here = (F.col("node") == F.col("newest_node")) & F.col("arrival_seq").eqNullSafe(
        F.col("newest_seq")
    )
    rows = merged.join(sized(newest, newest.count(), cfg.broadcast_rows), here)
    last = rows.groupBy("node").agg(F.max(F.struct("arrival_seq", *_UPDATE)).alias("newest"))
    return last.select("node", *[f"newest.{c}" for c in _UPDATE], F.lit(False).alias("removed"))


@dataclass(frozen=True)
class _Deltas:
    """What the nodes of a height make of their parents' sums, and the heights of these parents;
    of several, rows carry ``parent_height``."""

    rows: DataFrame
    heights: set[int]

    def of(self, height: int) -> DataFrame:
        if len(self.heights) == 1:
            return self.rows
        return self.rows.where(F.col("parent_height") == height).drop("parent_height")


class _Call:
    """One call's steps from height to height.

    ``changes`` and ``settled`` are written with the heights of their nodes and counted by them,
    so that the few groups of the upper heights are broadcast, however many sensors there are.
    ``first`` is the lowest arrival number of the call.
    """

    def __init__(
        self,
        state: MemberState,
        tree: Hierarchy,
        cfg: RollupConfig,
        changes: DataFrame,
        stamps: DataFrame,
        settled: DataFrame,
        first: int | None,
        last_call: bool,
    ):
        self.state, self.tree, self.cfg = state, tree, cfg
        self.first, self.last_call = F.lit(first).cast("bigint"), last_call
        stamps = write_table(stamps, "stamps")
        timed = changes.join(
            sized(stamps, stamps.count(), cfg.broadcast_rows), "arrival_seq", "left"
        )
        placed = write_table(self._placed(timed), "changes")
        self.changes = placed.where("arrival_seq IS NOT NULL")
        counted = placed.groupBy("height").agg(F.max("arrival_seq").alias("last")).collect()
        self.last_change = {r.height: r["last"] for r in counted}
        self.settled = write_table(self._placed(settled), "settled")
        counted = self.settled.groupBy("height").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("since") > self.first).alias("moved")
        )
        counts = counted.collect()
        self.settled_rows = {r.height: r.n for r in counts}
        self.moved_rows = {r.height: r.moved for r in counts}
        ends = tree.edges.join(self._heights("child"), "child", "left").select(
            F.coalesce("height", F.lit(0)).alias("below"), "parent"
        )
        ends = ends.join(self._heights("parent"), "parent").select("below", "height").distinct()
        self.heights_above: dict[int, set[int]] = {}
        for r in ends.collect():
            self.heights_above.setdefault(r.below, set()).add(r.height)

    def _heights(self, node: str) -> DataFrame:
        heights = self.tree.heights.withColumnRenamed("node", node)
        return sized(heights, self.tree.edge_rows, self.cfg.broadcast_rows)

    def _placed(self, rows: DataFrame) -> DataFrame:
        """With the height of each node; nodes without children are 0."""
        placed = rows.join(self._heights("node"), "node", "left")
        return placed.withColumn("height", F.coalesce("height", F.lit(0)))

    def _sized(self, rows: DataFrame, n: int) -> DataFrame:
        return sized(rows, n, self.cfg.broadcast_rows)

    def _known_windows(self, rows: DataFrame) -> DataFrame:
        """Rows in windows that earlier calls may have met: none of them begins after the newest
        event time that they left."""
        if self.state.clock is None:
            return rows
        return rows.where(F.unix_micros("window_start") <= F.lit(self.state.clock).cast("bigint"))

    def readings(self, arrivals: DataFrame) -> DataFrame:
        """Updates of height 0; a reading of a group raises."""
        rows = arrivals.where("identifier IS NOT NULL").withColumnRenamed("identifier", "node")
        refused = F.raise_error(F.concat(F.lit("a group reports itself: "), F.col("node")))
        units = F.coalesce(
            F.when(F.col("height").isNotNull(), refused.cast("bigint")), F.col("units")
        )
        return rows.join(self._heights("node"), "node", "left").select(
            "node",
            _window_of(F.col("event_time"), self.cfg).alias("window_start"),
            "arrival_seq",
            "payload_ts_ms",
            units.alias("units"),
            "event_time",
            "stream_time",
            F.lit(False).alias("gone"),
        )

    # -- from updates to what they change for each parent ------------------------------

    def deltas(self, updates: DataFrame, height: int) -> tuple[_Deltas, DataFrame]:
        """What updates and changes of the nodes of a height make of their parents' sums, and
        what the children among them are worth to each parent afterwards."""
        if height in self.last_change:
            placed = self._placed_over_changes(updates, height)
        else:
            placed = _for_parents(updates.join(self._settled_of(height), "node"))
        placed = placed.where(_open_until(self.cfg) > F.unix_micros("stream_time"))
        nothing = F.lit(None)
        placed = write_table(placed, "placed")
        carried = self.state.pairs.of(self._known_windows(placed)).select(
            *_PAIR,
            F.lit(_BEFORE).cast("bigint").alias("order"),
            nothing.cast("bigint").alias("arrival_seq"),
            "payload_ts_ms",
            "units",
            nothing.cast("timestamp").alias("event_time"),
            nothing.cast("timestamp").alias("stream_time"),
            F.lit(False).alias("removal"),
        )
        offers = placed.unionByName(write_table(carried, "carried"))
        # Without a change so far nothing can have been removed.
        removals = any(h <= height for h in self.last_change) and not (
            placed.where("removal").isEmpty()
        )
        made, kept = _pair_deltas(offers, removals, written=not self.last_call)
        made, above = made.where("parent IS NOT NULL"), self.heights_above.get(height, set())
        if len(above) > 1:
            links = self._heights("parent").withColumnRenamed("height", "parent_height")
            made = made.join(links, "parent")
        if len(above) > 1 or self.last_call:
            made = write_table(made, "deltas")
        return _Deltas(made, above), kept

    def _settled_of(self, height: int, moved: bool = False) -> DataFrame:
        """Settled parents for the updates of a height, of all nodes or of those that a change
        after the first arrival names; readings meet groups as well, and are refused there."""
        rows, counts = self.settled, self.moved_rows if moved else self.settled_rows
        if height > 0:
            rows, n = rows.where(F.col("height") == height), counts.get(height, 0)
        else:
            n = sum(counts.values())
        if moved:
            rows = rows.where(F.col("since") > self.first)
        return self._sized(rows.drop("height"), n)

    def _placed_over_changes(self, updates: DataFrame, height: int) -> DataFrame:
        """Updates for the parents known at their arrival, and what changes move and remove.

        Updates that no change of their node follows meet its settled parents, by one join. For
        the others one scan along the arrivals of each node finds both the parents known to an
        update and the update known to a change. Of the changes only those of nodes with such
        updates, or with one of an earlier call, take part: the others have nothing to move.
        Results of one group may reach several windows at one arrival: they share a place in that
        order, no change has it, and the newest is the last.
        """
        numbered = updates.where("arrival_seq IS NOT NULL")
        settled = _for_parents(
            numbered.join(self._settled_of(height), "node").where(
                "since IS NULL OR arrival_seq >= since"
            )
        )
        last_change = F.lit(self.last_change[height]).cast("bigint")
        followed = write_table(
            numbered.where(F.col("arrival_seq") < last_change)
            .join(self._settled_of(height, moved=True).select("node", "since"), "node")
            .where("arrival_seq < since"),
            "followed",
        )
        changes = self.changes.where(F.col("height") == height).drop("height")
        later = (2 * F.col("arrival_seq") + 1).alias("order")
        before = F.lit(_BEFORE).cast("bigint").alias("order")
        recent = write_table(
            self.state.last.of(changes).select(
                "node", (before + 1).alias("order"),
                F.struct((before + 1).alias("order"), *_UPDATE).alias("update"),
            ),
            "recent",
        )
        asked = write_table(
            followed.select("node").unionByName(recent.select("node")).distinct(), "asked"
        )
        asked = self._sized(asked, asked.count())

        def of_asked(rows: DataFrame, label: str) -> DataFrame:
            return write_table(rows.join(asked, "node", "left_semi"), label)

        changes = of_asked(changes, "moves")
        parents = self.state.parents.withColumnRenamed("child", "node")
        known = of_asked(parents, "known").select(
            "node", before, F.struct(before, "parents").alias("known")
        )
        frames = [
            followed.select(
                "node", later, "arrival_seq", "stream_time",
                F.struct(later, *_UPDATE).alias("update"),
            ),
            changes.select(
                "node", (2 * F.col("arrival_seq")).alias("order"), "arrival_seq", "stream_time",
                F.struct((2 * F.col("arrival_seq")).alias("order"), "parents").alias("known"),
                F.struct(
                    "event_time", "parents",
                    F.array_except("old_parents", "parents").alias("left"),
                ).alias("change"),
            ),
            known,
            recent,
        ]
        history = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        scanned = with_running(
            history,
            ["node"],
            "order",
            [Running("version", "max", "known"), Running("recent", "max", "update", before=True)],
        ).where("arrival_seq IS NOT NULL")

        changed = F.col("change").isNotNull()
        record_time = F.greatest("recent.event_time", "change.event_time")
        moved_to = F.when(
            ~F.col("recent.gone"), _targets(F.col("change.parents"), F.lit(False))
        ).otherwise(_targets(F.array().cast("array<string>"), F.lit(False)))
        if self.cfg.on_removal != "ignore":
            moved_to = F.concat(moved_to, _targets(F.col("change.left"), F.lit(True)))
        met = _targets(F.col("version.parents"), F.col("update.gone"))

        def either(of_change: Column, of_update: str) -> Column:
            return F.when(changed, of_change).otherwise(F.col(f"update.{of_update}"))

        moved = _offers(
            scanned.select(
                "node",
                either(_window_at(record_time, self.cfg), "window_start").alias("window_start"),
                F.col("order"),
                "arrival_seq",
                either(F.col("recent.payload_ts_ms"), "payload_ts_ms").alias("payload_ts_ms"),
                either(F.col("recent.units"), "units").alias("units"),
                either(record_time, "event_time").alias("event_time"),
                "stream_time",
                F.explode(F.when(changed, moved_to).otherwise(met)).alias("target"),
            )
        )
        return settled.unionByName(moved)

    # -- from changes of sums to results -----------------------------------------------

    def results(
        self, deltas: list[_Deltas], height: int
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Changelog of the groups of a height, the same as updates, and their results now."""
        arriving = [d.of(height) for d in deltas if height in d.heights]
        steps = reduce(DataFrame.unionByName, arriving or [deltas[0].rows.limit(0)]).select(
            "window_start",
            F.col("parent").alias("node"),
            "arrival_seq",
            "joins",
            F.col("delta").alias("moves_0"),
            "payload_ts_ms",
            F.col("event_time").alias("record_time"),
            "stream_time",
        )
        keys = ["window_start", "node"]
        hot = hot_buckets(steps, keys, "arrival_seq")
        if hot:
            # A large group gets one row an arrival before its rows come together.
            steps = write_table(_by_arrival(steps), "fresh")
        carried = self.state.groups.of(self._known_windows(steps)).select(
            "window_start",
            "node",
            F.lit(_BEFORE).cast("bigint").alias("arrival_seq"),
            F.col("n").alias("joins"),
            F.col("total").alias("moves_0"),
            F.col("newest").alias("payload_ts_ms"),
            F.col("event_time").alias("record_time"),
            F.lit(None).cast("timestamp").alias("stream_time"),
        )
        steps = steps.unionByName(write_table(carried, "carried"))
        # Rows of one group are in one place, so that they are dealt out only once.
        fresh = steps if hot else _by_arrival(steps.repartition(*keys))
        after = (
            running_results(fresh, "node", hot=None if hot else [])
            .where(F.col("arrival_seq") > _BEFORE)
            .withColumnRenamed("total_0", "total")
        )
        if not self.last_call or height < self.tree.height:
            after = write_table(after, "results")
        updates = after.select(
            "node",
            "window_start",
            "arrival_seq",
            F.col("newest").alias("payload_ts_ms"),
            F.col("total").alias("units"),
            "event_time",
            "stream_time",
            (F.col("n") == 0).alias("gone"),
        )
        now = steps.groupBy(*keys).agg(
            F.sum("joins").alias("n"),
            F.sum("moves_0").alias("total"),
            F.max("payload_ts_ms").alias("newest"),
            F.max("record_time").alias("event_time"),
            F.lit(False).alias("removed"),
        )
        return self.log_of(after), updates, now

    def log_of(self, results: DataFrame) -> DataFrame:
        extra = ("event_time", "arrival_seq", "stream_time")
        with_bounds = replace(self.cfg, drop_window=False)
        return results.select(*result_columns(with_bounds, "node", "n", "total", "newest", extra))


def _by_arrival(steps: DataFrame) -> DataFrame:
    """One row for each group, window and arrival."""
    return steps.groupBy("window_start", "node", "arrival_seq").agg(
        F.sum("joins").alias("joins"),
        F.sum("moves_0").alias("moves_0"),
        F.max("payload_ts_ms").alias("payload_ts_ms"),
        F.max("record_time").alias("record_time"),
        F.max("stream_time").alias("stream_time"),
    )


def _targets(parents: Column, removal: Column) -> Column:
    """The parents that a row goes to, and whether it takes the value of the node from them."""
    return F.transform(parents, lambda p: F.struct(p.alias("parent"), removal.alias("removal")))


def _for_parents(updates: DataFrame) -> DataFrame:
    """A row for each of the parents; a gone node takes its value away from them."""
    return _offers(
        updates.select(
            "*",
            (2 * F.col("arrival_seq") + 1).alias("order"),
            F.explode(_targets(F.col("parents"), F.col("gone"))).alias("target"),
        )
    )


def _offers(rows: DataFrame) -> DataFrame:
    removal = F.col("target.removal")
    return rows.select(
        "window_start",
        F.col("node").alias("child"),
        F.col("target.parent").alias("parent"),
        "order",
        "arrival_seq",
        F.when(~removal, F.col("payload_ts_ms")).alias("payload_ts_ms"),
        F.when(~removal, F.col("units")).alias("units"),
        "event_time",
        "stream_time",
        removal.alias("removal"),
    )


def _pair_deltas(
    offers: DataFrame, with_removals: bool, written: bool
) -> tuple[DataFrame, DataFrame]:
    """(window_start, parent, arrival_seq, delta, joins, ...) of each offer that arrived in this
    call, and the value of each of their pairs after all of them, or that it has none; ``written``
    if both are read.

    Between two removals a pair keeps its newest offer, so the removals that came before
    number the stretches in which offers replace each other.
    """
    segment = F.lit(0).cast("bigint")
    rows = offers.withColumn("segment", segment)
    hot = hot_buckets(offers, _PAIR, "order")
    if with_removals:
        counted = with_running(
            offers.withColumn("_one", F.col("removal").cast("bigint")),
            _PAIR,
            "order",
            [Running("segment", "sum", "_one", before=True)],
            hot=hot,
        )
        rows = counted.withColumn("segment", F.coalesce("segment", segment)).drop("_one")
        if hot:
            rows = write_table(rows, "segments")
    offer = F.when(~F.col("removal"), F.struct("payload_ts_ms", "order", "units"))
    rows = rows.withColumn("offer", offer)
    # A stretch has no more rows than its pair.
    scanned = with_running(
        rows,
        [*_PAIR, "segment"],
        "order",
        [Running("replaced", "max", "offer", before=True)],
        hot=None if hot else [],
    )
    if written:
        scanned = write_table(scanned, "scanned")
    had = F.col("replaced").isNotNull()
    wins = ~had | (F.col("offer") > F.col("replaced"))
    old = F.coalesce("replaced.units", F.lit(0))
    made = scanned.where((F.col("order") > _BEFORE) & (~F.col("removal") | had)).select(
        "window_start",
        "parent",
        "arrival_seq",
        F.when(F.col("removal"), -old)
        .when(wins, F.col("units") - old)
        .otherwise(F.lit(0))
        .alias("delta"),
        F.when(F.col("removal"), F.lit(-1))
        .otherwise((~had).cast("int"))
        .cast("bigint")
        .alias("joins"),
        "payload_ts_ms",
        "event_time",
        "stream_time",
    )
    kept = (
        scanned.groupBy(*_PAIR)
        .agg(
            F.max(F.struct("segment", "offer")).alias("newest"),
            F.sum(F.col("removal").cast("bigint")).alias("removals"),
        )
        .select(
            *_PAIR,
            "newest.offer.payload_ts_ms",
            "newest.offer.units",
            (F.col("newest.segment") != F.col("removals")).alias("removed"),
        )
    )
    return made, kept


def results_of(groups: DataFrame, cfg: RollupConfig) -> DataFrame:
    """The results that rows of the table of groups stand for; groups without children have none."""
    return groups.where("n > 0").select(*result_columns(cfg, "node", "n", "total", "newest"))
