"""Streaming roll-up under memberships that change: readings and registry in one query.

Every micro-batch goes through ``follow_members`` as stored input does, from the tables that
the batch before left: stream time, the parents and the last update of every node, which
outlive all windows, and the pairs and groups of the open windows. So a stream gives the rows of
one call over all of it, however it is cut. Of last updates, pairs and groups a batch reads and
writes only those it touches (``streaming.state``). A batch that is run again after a failure
reads the same tables, and overwrites its own and its output; older tables are removed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from treewatt.config import RollupConfig, require
from treewatt.functions.tables import delete, temporary_tables, write_table
from treewatt.operators.members import (
    KEYED_TABLES,
    WHOLE_TABLES,
    MemberState,
    follow_members,
    is_open,
    no_state,
    results_of,
)
from treewatt.operators.registry import changes_after, snapshot_events
from treewatt.operators.throttle import throttle
from treewatt.schemas import MEASUREMENT
from treewatt.streaming.state import KeyedTable

EMISSIONS = ("final", "changelog", "throttled")


def member_rows(readings: DataFrame, events: DataFrame) -> DataFrame:
    """Readings and registry events as the rows of one stream or table.

    Their arrival numbers must be one order; no two rows may share a number.
    """
    columns = ["event_type", "payload", "event_time", "arrival_seq"]
    return readings.select(*MEASUREMENT.names).unionByName(
        events.select(*columns), allowMissingColumns=True
    )


@dataclass(frozen=True)
class MemberRollup:
    """A ``foreachBatch`` function over ``member_rows``.

    state       folder of the carried tables
    output      folder that gets one sub-folder of results per batch
    emission    "final": one result when a window closes; "changelog": every update;
                "throttled": rate-limited updates
    publish     called with the written results of each batch and its number
    """

    cfg: RollupConfig
    state: str
    output: str
    emission: str = "throttled"
    publish: Callable[[DataFrame, int], None] | None = None

    def __post_init__(self) -> None:
        require(cfg=self.cfg, state=self.state, output=self.output)
        if self.emission not in EMISSIONS:
            raise ValueError(f"emission must be one of {EMISSIONS}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with temporary_tables(spark):
            self._step(write_table(batch, "batch"), batch_id)
        # This batch may be run again from the tables of the one before, from no older ones.
        for name in (*WHOLE_TABLES, "clock", "entries"):
            if batch_id > 1:
                delete(spark, self._folder(name, batch_id - 2))
        for table in self._tables().values():
            table.expire(spark, batch_id)

    def _tables(self) -> dict[str, KeyedTable]:
        return {
            name: KeyedTable(f"{self.state}/{name}", schema, keys)
            for name, (schema, keys) in KEYED_TABLES.items()
        }

    def _step(self, rows: DataFrame, batch_id: int) -> None:
        spark, cfg = rows.sparkSession, self.cfg
        before = self._load(spark, batch_id - 1)
        snapshots = write_table(
            snapshot_events(rows).select("arrival_seq", "event_time", "payload"), "snapshots"
        )
        changes = changes_after(before.parents, snapshots)
        readings = rows.where("identifier IS NOT NULL").select(*MEASUREMENT.names)
        log, after = follow_members(readings, changes, before, cfg)
        # No later batch asks for windows that this one has closed; but final results need the
        # groups of those that were open before it.
        open_now, open_before = is_open(after.clock, cfg), is_open(before.clock, cfg)
        wanted = {"pairs": open_now, "groups": open_before if self.emission == "final" else open_now}
        for name, table in self._tables().items():
            changed = getattr(after, name)
            if name in wanted:
                changed = changed.where(wanted[name])
            table.save(changed, batch_id, wanted.get(name))
        if self.emission == "changelog":
            self._emit(log, batch_id)
        elif self.emission == "final":
            groups = self._tables()["groups"].at(spark, batch_id).whole()
            closed = groups.where(~open_now & open_before)
            self._emit(results_of(closed, cfg), batch_id)
        else:
            carried = self._read(spark, "entries", batch_id - 1) if batch_id > 0 else None
            released, waiting = throttle(log, after.clock, cfg, carried)
            self._emit(released, batch_id)
            self._save(waiting, "entries", batch_id)
        for name in WHOLE_TABLES:
            self._save(getattr(after, name), name, batch_id)
        clock = spark.range(1).select(F.lit(after.clock).cast("bigint").alias("clock"))
        self._save(clock, "clock", batch_id)

    def _emit(self, results: DataFrame, batch_id: int) -> None:
        folder = f"{self.output}/batch_id={batch_id}"
        results.write.mode("overwrite").parquet(folder)
        if self.publish is not None:
            self.publish(results.sparkSession.read.schema(results.schema).parquet(folder), batch_id)

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.state}/{name}/batch_id={batch_id}"

    def _save(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(name, batch_id))

    def _read(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        return spark.read.parquet(self._folder(name, batch_id))

    def _load(self, spark: SparkSession, batch_id: int) -> MemberState:
        if batch_id < 0:
            return no_state(spark)
        whole = {name: self._read(spark, name, batch_id) for name in WHOLE_TABLES}
        keyed = {name: table.at(spark, batch_id) for name, table in self._tables().items()}
        return MemberState(self._read(spark, "clock", batch_id).first()["clock"], **whole, **keyed)


def member_writer(rows: DataFrame, rollup: MemberRollup, checkpoint: str) -> DataStreamWriter:
    """Streaming query over ``member_rows`` of two streams."""
    require(rows=rows, checkpoint=checkpoint)
    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(rollup)
