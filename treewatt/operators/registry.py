"""Registry snapshots: filter, flatten, validate, difference, current state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.functions.running import with_next, with_previous
from treewatt.functions.tables import setting, write_table
from treewatt.schemas import REGISTRY_SNAPSHOT_EVENTS

# Texts of nodes up to this length are taken apart as one VARIANT.
_PIECE_BYTES = 1 << 23
# Snapshots of up to this length in all may be walked over the driver, whatever their depth.
_DRIVER_BYTES = 1 << 18

_CHANGES = (
    "child string, op string, old_parents array<string>, parents array<string>, "
    "arrival_seq bigint, event_time timestamp"
)


def snapshot_events(events: DataFrame) -> DataFrame:
    """Keep the events that carry a registry snapshot."""
    return events.where(F.col("event_type").isin(*REGISTRY_SNAPSHOT_EVENTS))


def flatten_registry(
    events: DataFrame,
    *,
    identifier_field: str = "identifier",
    children_field: str = "children",
) -> DataFrame:
    """Registry JSON to edges ``(arrival_seq, event_time, child, parent, level)``.

    Every node but the root becomes one row. The walk goes one tree level per step over
    all snapshots at once, without a limit on rows or depth; it ends where no node has
    children. The edges are written to the shared folder, as Spark reads the limits of a
    recursion when it runs.

    A document is one row, so one task reads it. Nodes whose text is longer than a set size are
    cut into the texts of their children first, which are dealt out to all tasks: what becomes
    a VARIANT stays well below the size that one may have. In a node that is cut, children that
    are no array raise, and fields that are paths, not names, are never cut. The driver gets
    rows of the walk from short documents alone.
    """
    spark = events.sparkSession
    pieces, cut, size = _cut(events, identifier_field, children_field)
    walk = _walk(pieces, identifier_field, children_field)
    if cut is not None:
        walk = walk.unionByName(cut)
    on_driver = "spark.sql.cteRecursionAnchorRowsLimitToConvertToLocalRelation"
    rows = spark.conf.get(on_driver) if size <= _DRIVER_BYTES else "0"
    with (
        setting(spark, "spark.sql.cteRecursionRowLimit", "-1"),
        setting(spark, "spark.sql.cteRecursionLevelLimit", "-1"),
        setting(spark, on_driver, rows),
    ):
        return write_table(walk.repartition("child"), "registry")


def _cut(
    events: DataFrame, identifier_field: str, children_field: str
) -> tuple[DataFrame, DataFrame | None, int]:
    """Texts of nodes, none of them long, with their parents and levels; the edges of the nodes
    that were cut for it, if any; and the length of all texts together."""
    pieces = events.select(
        "arrival_seq",
        "event_time",
        F.col("payload").alias("text"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).alias("level"),
    )
    length = F.coalesce(F.octet_length("text"), F.lit(0))
    schema = f"`{identifier_field}` variant, `{children_field}` array<string>"
    named = identifier_field.isidentifier() and children_field.isidentifier()
    short: list[DataFrame] = []
    edges: list[DataFrame] = []
    total = None
    while True:
        sizes = pieces.agg(F.max(length).alias("longest"), F.sum(length).alias("all")).first()
        total = (sizes["all"] or 0) if total is None else total
        if not named or (sizes.longest or 0) <= _PIECE_BYTES:
            short.append(pieces)
            break
        short.append(pieces.where(length <= _PIECE_BYTES))
        node = F.from_json("text", schema, {"mode": "FAILFAST"}).alias("node")
        nodes = pieces.where(length > _PIECE_BYTES).select(
            "arrival_seq", "event_time", "parent", "level", node
        )
        below = nodes.select(
            "arrival_seq",
            "event_time",
            F.variant_get(f"node.{identifier_field}", "$", "string").alias("child"),
            "parent",
            "level",
            F.posexplode_outer(f"node.{children_field}").alias("place", "text"),
        )
        below = write_table(below.repartition(F.xxhash64("text", "place")), "pieces")
        edges.append(
            below.where("level > 0 AND coalesce(place, 0) = 0").select(
                "arrival_seq", "event_time", "child", "parent", "level"
            )
        )
        pieces = below.where("place IS NOT NULL").select(
            "arrival_seq",
            "event_time",
            "text",
            F.col("child").alias("parent"),
            (F.col("level") + 1).alias("level"),
        )
    cut = reduce(DataFrame.unionByName, edges) if edges else None
    return reduce(DataFrame.unionByName, short), cut, total


def _walk(pieces: DataFrame, identifier_field: str, children_field: str) -> DataFrame:
    return pieces.sparkSession.sql(
        """
        WITH RECURSIVE walk(arrival_seq, event_time, node, parent, level) AS (
          SELECT arrival_seq, event_time, parse_json(text), parent, level
          FROM {pieces}
          UNION ALL
          SELECT w.arrival_seq, w.event_time, c.value,
                 variant_get(w.node, {identifier}, 'string'), w.level + 1
          FROM walk AS w,
               LATERAL variant_explode(variant_get(w.node, {children}, 'variant')) AS c
        )
        SELECT arrival_seq, event_time, variant_get(node, {identifier}, 'string') AS child,
               parent, level
        FROM walk WHERE level > 0
        """,
        pieces=pieces,
        identifier=f"$.{identifier_field}",
        children=f"$.{children_field}",
    )


def duplicate_identifiers(edges: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Identifiers that occur more than once in a snapshot."""
    keys = [snapshot, "child"] if snapshot else ["child"]
    return edges.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def unique_identifiers(edges: DataFrame, snapshot: str | None = None) -> DataFrame:
    """The edges themselves; raises now if a snapshot names a node more than once."""
    repeated = duplicate_identifiers(edges, snapshot).first()
    if repeated is not None:
        raise ValueError(f"duplicate identifier: {repeated.child}")
    return edges


def refuse_duplicates(edges: DataFrame, snapshot: str | None = None) -> DataFrame:
    """The parent of each node as a set, raising when a snapshot repeats a node."""
    keys = [snapshot, "child"] if snapshot else ["child"]
    repeated = F.raise_error(F.concat(F.lit("duplicate identifier: "), F.col("child")))
    return (
        edges.groupBy(*keys)
        .agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
        .select(
            *keys,
            F.when(F.col("n") > 1, repeated.cast("array<string>"))
            .otherwise(F.array("parent"))
            .alias("parents"),
        )
    )


def parent_sets(edges: DataFrame, *keys: str) -> DataFrame:
    """Sorted set of parents per child; several parents are kept."""
    return edges.groupBy(*keys, "child").agg(
        F.array_sort(F.collect_set("parent")).alias("parents")
    )


def diff_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes between two parent-set tables: ``(child, op, old_parents, parents)``.

    New and changed children are upserts, vanished ones deletes; unchanged children
    yield no row.
    """
    pair = old.select("child", F.col("parents").alias("old_parents")).join(
        new.select("child", F.col("parents").alias("parents")), "child", "full_outer"
    )
    return pair.where(~F.col("old_parents").eqNullSafe(F.col("parents"))).select(
        "child",
        F.when(F.col("parents").isNull(), "delete").otherwise("upsert").alias("op"),
        "old_parents",
        "parents",
    )


def diff_history(edges: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """All changes along a history of snapshots, in arrival order of the snapshots.

    ``edges`` is the output of ``flatten_registry`` over whole snapshots, ``events`` are
    the snapshots themselves (``arrival_seq``, ``event_time``): a snapshot of a root
    without children has no edge and deletes all. A child's versions are compared with
    the snapshot right before it, so a child that leaves and returns gives a delete and
    an upsert.
    """
    stated = edges if events is None else events
    snapshots = write_table(stated.select("arrival_seq", "event_time").distinct(), "snapshots")
    neighbours = with_next(
        with_previous(snapshots, [], "arrival_seq", [], "before"),
        [],
        "arrival_seq",
        ["event_time"],
        "after",
    )
    timeline = neighbours.select(
        "arrival_seq",
        F.col("before.arrival_seq").alias("previous_seq"),
        F.col("after.arrival_seq").alias("next_seq"),
        F.col("after.event_time").alias("next_time"),
    )
    sets = write_table(
        parent_sets(edges, "arrival_seq", "event_time").join(timeline, "arrival_seq"), "sets"
    )
    seen = with_next(
        with_previous(sets, ["child"], "arrival_seq", ["parents"], "seen"),
        ["child"],
        "arrival_seq",
        [],
        "again",
    ).select(
        *sets.columns,
        F.col("seen.arrival_seq").alias("seen_seq"),
        F.col("seen.parents").alias("seen_parents"),
        F.col("again.arrival_seq").alias("again_seq"),
    )
    continued = F.col("seen_seq").eqNullSafe(F.col("previous_seq")) & F.col("seen_seq").isNotNull()
    upserts = seen.where(~continued | (F.col("seen_parents") != F.col("parents"))).select(
        "child",
        F.lit("upsert").alias("op"),
        F.when(continued, F.col("seen_parents")).alias("old_parents"),
        "parents",
        "arrival_seq",
        "event_time",
    )
    gone = F.col("next_seq").isNotNull() & ~F.col("again_seq").eqNullSafe(F.col("next_seq"))
    deletes = seen.where(gone).select(
        "child",
        F.lit("delete").alias("op"),
        F.col("parents").alias("old_parents"),
        F.lit(None).cast("array<string>").alias("parents"),
        F.col("next_seq").alias("arrival_seq"),
        F.col("next_time").alias("event_time"),
    )
    return upserts.unionByName(deletes)


def changes_after(known: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Changes that snapshots ``(arrival_seq, event_time, payload)`` bring to known memberships
    ``(child, parents)``, in the shape of ``diff_history``.

    Each snapshot is compared with the one before it, the first with what is known. Hand in
    written tables; a snapshot that names a node twice raises.
    """
    stamp = snapshots.agg(
        F.min("arrival_seq").alias("arrival_seq"),
        F.max("arrival_seq").alias("last_seq"),
        F.min_by("event_time", "arrival_seq").alias("event_time"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if stamp.n == 0:
        return snapshots.sparkSession.createDataFrame([], _CHANGES).limit(0)
    edges = unique_identifiers(flatten_registry(snapshots), "arrival_seq")
    if stamp.arrival_seq is None:
        return diff_history(edges, snapshots)
    first = edges.where(F.col("arrival_seq") == stamp.arrival_seq)
    changes = (
        diff_snapshots(known, parent_sets(first))
        .withColumn("arrival_seq", F.lit(stamp.arrival_seq).cast("bigint"))
        .withColumn("event_time", F.lit(stamp.event_time))
    )
    if stamp.last_seq == stamp.arrival_seq:
        return changes
    return changes.unionByName(
        diff_history(edges, snapshots).where(F.col("arrival_seq") > F.lit(stamp.arrival_seq))
    )


def current_parents(changes: DataFrame) -> DataFrame:
    """Parents known after all changes: the last change per child, deletes dropped."""
    last = changes.groupBy("child").agg(
        F.max_by(F.struct("op", "parents"), "arrival_seq").alias("last")
    )
    return last.where("last.op = 'upsert'").select("child", F.col("last.parents").alias("parents"))


def versioned_edges(changes: DataFrame) -> DataFrame:
    """Changes to validity intervals ``(child, parents, valid_from, valid_to)``.

    ``valid_to`` is exclusive and null while the version is current.
    """
    history = with_next(changes, ["child"], "arrival_seq", ["event_time"], "after")
    return (
        history.select(
            "child",
            "op",
            "parents",
            F.col("event_time").alias("valid_from"),
            F.col("after.event_time").alias("valid_to"),
        )
        .where("op = 'upsert'")
        .drop("op")
    )


def membership_retractions(changes: DataFrame) -> DataFrame:
    """One row per (child, parent) the child no longer belongs to."""
    now = F.coalesce("parents", F.array().cast("array<string>"))
    left = F.array_except(F.coalesce("old_parents", F.array().cast("array<string>")), now)
    passed = [c for c in ("arrival_seq", "event_time") if c in changes.columns]
    return changes.select(
        "child", F.explode(left).alias("parent"), F.lit("delete").alias("op"), *passed
    )
