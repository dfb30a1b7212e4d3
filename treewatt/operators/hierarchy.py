"""A prepared hierarchy: heights, closure, counted sizes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.functions.tables import sized, write_table

# Paths longer than this are written level by level instead of planned in one go.
_PLANNED_LEVELS = 6


@dataclass(frozen=True)
class Hierarchy:
    """Edges ``(child, parent)`` and heights ``(node, height)`` of the nodes that have
    children; ``height`` is that of the highest, i.e. the edges of the longest path.

    The larger tables are written to the shared folder when first used.
    """

    edges: DataFrame
    edge_rows: int
    heights: DataFrame
    height: int
    broadcast_rows: int

    @cached_property
    def nodes(self) -> DataFrame:
        """``(child, parents, height)`` of every node that has a parent; leaves are 0."""
        of_child = self.heights.withColumnRenamed("node", "child")
        parents = self.edges.groupBy("child").agg(F.collect_list("parent").alias("parents"))
        return write_table(
            parents.join(self._sized(of_child), "child", "left").select(
                "child", "parents", F.coalesce("height", F.lit(0)).alias("height")
            ),
            "nodes",
        )

    def sized_nodes(self, height: int | None = None) -> DataFrame:
        """All nodes, or those of one height."""
        nodes = self.nodes if height is None else self.nodes.where(F.col("height") == height)
        return self._sized(nodes)

    @cached_property
    def links(self) -> DataFrame:
        """Edges with the heights of both ends."""
        of_child = self.heights.withColumnRenamed("node", "child")
        of_parent = self.heights.select(
            F.col("node").alias("parent"), F.col("height").alias("parent_height")
        )
        return write_table(
            self.edges.join(self._sized(of_child), "child", "left")
            .join(self._sized(of_parent), "parent")
            .withColumn("height", F.coalesce("height", F.lit(0))),
            "links",
        )

    @cached_property
    def closure(self) -> DataFrame:
        """``(leaf, ancestor, via_child, depth, paths, inner)`` for all paths upward.

        ``via_child`` is the direct child of ``ancestor`` the path runs through,
        ``paths`` how many paths run that way (1 in a tree), and ``inner`` tells that
        ``leaf`` itself has children.
        """
        up = self._sized(
            self.edges.select(F.col("child").alias("ancestor"), F.col("parent").alias("next"))
        )
        keys = ["leaf", "ancestor", "via_child", "depth"]
        level = self.edges.select(
            F.col("child").alias("leaf"),
            F.col("parent").alias("ancestor"),
            F.col("child").alias("via_child"),
            F.lit(1).alias("depth"),
            F.lit(1).cast("bigint").alias("paths"),
        )
        levels = [level]
        for _ in range(1, self.height):
            level = level.join(up, "ancestor").select(
                "leaf",
                F.col("next").alias("ancestor"),
                F.col("ancestor").alias("via_child"),
                (F.col("depth") + 1).alias("depth"),
                "paths",
            )
            # Paths that meet are one row from here on, whatever the depth.
            level = level.groupBy(*keys).agg(F.sum("paths").alias("paths"))
            if self.height > _PLANNED_LEVELS:
                level = write_table(level, "paths")
            levels.append(level)
        inner = self.heights.select(F.col("node").alias("leaf"), F.lit(True).alias("inner"))
        return write_table(
            reduce(DataFrame.unionByName, levels)
            .groupBy("leaf", "ancestor", "via_child")
            .agg(F.max("depth").alias("depth"), F.sum("paths").alias("paths"))
            .join(self._sized(inner), "leaf", "left")
            .withColumn("inner", F.coalesce("inner", F.lit(False))),
            "closure",
        )

    @cached_property
    def closure_rows(self) -> int:
        return self.closure.count()

    def sized_closure(self) -> DataFrame:
        return sized(self.closure, self.closure_rows, self.broadcast_rows)

    def _sized(self, dimension: DataFrame) -> DataFrame:
        """For tables with at most one row per edge."""
        return sized(dimension, self.edge_rows, self.broadcast_rows)


def build_hierarchy(
    edges: DataFrame,
    *,
    depth: int | None = None,
    broadcast_rows: int = 1_000_000,
) -> Hierarchy:
    """Prepare a hierarchy once, for any number of roll-ups.

    A node has height k or more if it is the parent of one with height k - 1 or more, so
    the heights come from the edges between groups alone, one step per height. With
    ``depth`` stated (the longest path, e.g. the largest level of a flattened tree) all
    steps are one job and a deeper tree raises; without it there is one small job per
    height, and a cycle raises once there are more heights than nodes with children.
    """
    pairs = write_table(edges.select("child", "parent").distinct(), "edges")
    edge_rows = pairs.count()

    def parents_of(nodes: DataFrame) -> DataFrame:
        children = sized(nodes.withColumnRenamed("node", "child"), edge_rows, broadcast_rows)
        return pairs.join(children, "child", "left_semi").select(F.col("parent").alias("node"))

    level = pairs.select(F.col("parent").alias("node"))
    levels = [level]
    if depth is not None:
        for _ in range(depth):
            level = parents_of(level)
            levels.append(level)
    else:
        level = write_table(level.distinct(), "height")
        parents = level.count()
        levels = []
        while not level.isEmpty():
            levels.append(level)
            if len(levels) > parents:
                raise ValueError("hierarchy has a cycle")
            level = write_table(parents_of(level).distinct(), "height")
        levels = levels or [level]
    numbered = [nodes.withColumn("height", F.lit(k)) for k, nodes in enumerate(levels, start=1)]
    heights = write_table(
        reduce(DataFrame.unionByName, numbered).groupBy("node").agg(
            F.max("height").alias("height")
        ),
        "heights",
    )
    height = heights.agg(F.max("height")).first()[0] or 0
    if depth is not None and height > depth:
        raise ValueError(f"hierarchy has a cycle or is deeper than the stated depth {depth}")
    return Hierarchy(pairs, edge_rows, heights, height, broadcast_rows)
