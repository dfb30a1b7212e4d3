"""Keeping the hierarchy current from a stream of registry events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from treewatt.config import require
from treewatt.functions.tables import write_table
from treewatt.operators.hierarchy import Hierarchy, build_hierarchy
from treewatt.operators.registry import (
    changes_after,
    current_parents,
    snapshot_events,
)


@dataclass(frozen=True)
class RegistryFeed:
    """A ``foreachBatch`` function that turns snapshots into a table of changes.

    Each batch compares its snapshots with the memberships left by the batch before and
    writes two tables of its own: the changes, and the memberships after them. Batches
    without a snapshot carry the memberships on unchanged. Events with a
    ``source_partition`` are numbered by their partitions: they get numbers of their own, in
    which the snapshots of a batch take turns and come after those of earlier batches.
    """

    state: str

    def __post_init__(self) -> None:
        require(state=self.state)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshots = write_table(
            _numbered(snapshot_events(batch), batch_id).select(
                "arrival_seq", "event_time", "payload"
            ),
            "snapshots",
        )
        known = self.memberships(spark, batch_id - 1)
        changes = changes_after(known, snapshots)
        changes.write.mode("overwrite").parquet(self._folder("changes", batch_id))
        changes = spark.read.parquet(self._folder("changes", batch_id))
        kept = known.join(changes.select("child").distinct(), "child", "left_anti")
        kept.unionByName(current_parents(changes)).write.mode("overwrite").parquet(
            self._folder("memberships", batch_id)
        )

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.state}/{name}/batch_id={batch_id}"

    def memberships(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``(child, parents)`` as known after a batch."""
        if batch_id < 0:
            return spark.createDataFrame([], "child string, parents array<string>")
        return spark.read.parquet(self._folder("memberships", batch_id))

    def changes(self, spark: SparkSession) -> DataFrame:
        """All changes so far, in the shape of ``diff_history``."""
        return spark.read.parquet(f"{self.state}/changes").drop("batch_id")

    def hierarchy(
        self, spark: SparkSession, batch_id: int | None = None, broadcast_rows: int = 1_000_000
    ) -> Hierarchy:
        """The hierarchy after a batch, read from its memberships; without its number the
        one after all changes so far."""
        known = (
            current_parents(self.changes(spark))
            if batch_id is None
            else self.memberships(spark, batch_id)
        )
        edges = known.selectExpr("child", "explode(parents) AS parent")
        return build_hierarchy(edges, broadcast_rows=broadcast_rows)


def _numbered(snapshots: DataFrame, batch_id: int) -> DataFrame:
    if "source_partition" not in snapshots.columns:
        return snapshots
    place = ["arrival_seq", "source_partition"]
    # Registry events are rare: the few of a batch, without their payloads, are one window.
    ranks = snapshots.select(*place).withColumn(
        "_rank", F.row_number().over(Window.orderBy(*place)) + F.lit(batch_id * 2**32)
    )
    return snapshots.join(ranks, place).withColumn("arrival_seq", F.col("_rank").cast("bigint"))


def registry_writer(events: DataFrame, feed: RegistryFeed, checkpoint: str) -> DataStreamWriter:
    """Streaming query that keeps the change table current."""
    require(events=events, checkpoint=checkpoint)
    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(feed)
