"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.llm.common import Scratch


def _centre(pairs: DataFrame) -> DataFrame:
    """For every node its smallest neighbour or itself."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m")
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_centre(both), F.col("u") == F.col("c")).where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_centre(down), F.col("u") == F.col("c"))
    moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = joined.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).where("u != v").distinct()


def _print_of(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest of its component.

    links has two bigint columns, in any direction, with repeats and loops allowed; nulls
    are left out. Large-star and small-star steps, each written to the shared folder, until
    nothing changes: the number of steps grows with the logarithm of the nodes, a step only
    aggregates minima and joins, and nothing but one row of counts reaches the driver.
    """
    a, b = links.columns[:2]
    pairs = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u != v")
        .distinct()
    )
    current = scratch.write(pairs, f"{name}-0")
    seen, step = _print_of(current), 0
    while seen[0]:
        step += 1
        current = scratch.write(_small_star(_large_star(current)), f"{name}-{step}")
        now = _print_of(current)
        if step > 1:
            scratch.drop(f"{name}-{step - 1}")
        if now == seen:
            break
        seen = now
    members = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)
