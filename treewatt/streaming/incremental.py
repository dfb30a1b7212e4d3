"""Exact streaming roll-up: the batch operators applied to one micro-batch at a time.

Spark's watermark lags a micro-batch behind, so it bounds state but lets readings in that
had been late already. Here stream time, the last value of each sensor in the open
windows and the open throttle entries are carried from batch to batch as small written
tables, and every micro-batch runs through the same operators as stored input: no keyed
Python state, and a hot sensor, source or root is split the same way.

Each batch reads the tables of the batch before it and overwrites its own, so a batch
that is run again after a failure gives the same tables and the same output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from treewatt.config import RollupConfig, require
from treewatt.functions.columns import (
    from_summable,
    replay_order,
    summable,
    window_end,
    with_window_start,
)
from treewatt.functions.tables import write_table
from treewatt.operators.changelog import aggregate_changelog, changelog_by_height
from treewatt.operators.hierarchy import Hierarchy
from treewatt.operators.late import accepted as accepted_readings
from treewatt.operators.late import with_release_time, with_stream_time
from treewatt.operators.rollup import rollup_values
from treewatt.operators.throttle import throttle

EMISSIONS = ("final", "changelog", "throttled")

# Moves arrivals of earlier batches before all arrivals of the current one.
_EARLIER = 2**61

# Arrival numbers of a source are this far apart, so that each source has its own in between.
_SOURCES = 2**16
_SOURCE_STATE = [T.StructField("source_no", T.LongType()), T.StructField("clock", T.LongType())]


@dataclass(frozen=True)
class IncrementalRollup:
    """A ``foreachBatch`` function.

    hierarchy   the tree, or a function returning the tree to use from this batch on
    state       folder for the carried tables; batches older than the last two are not
                read again and may be expired
    output      folder that gets one sub-folder of results per batch
    emission    "final": one result when a window closes; "changelog": every update;
                "throttled": rate-limited updates
    groups_report   whether groups may send readings of their own
    publish     called with the written results of each batch and its number, for example
                ``bus_batches(options)``; a batch that is run again is published again
    by          columns that name the source of a reading. Each source then has a clock of its
                own, which decides lateness and is carried, and numbers its readings itself.
                Windows close, and entries are released, by the time that all sources have
                reached.
    sources     how many sources there are: nothing closes before so many have reported
    """

    hierarchy: Hierarchy | Callable[[], Hierarchy]
    cfg: RollupConfig
    state: str
    output: str
    emission: str = "throttled"
    groups_report: bool = False
    publish: Callable[[DataFrame, int], None] | None = None
    by: tuple[str, ...] = ()
    sources: int = 1

    def __post_init__(self) -> None:
        require(hierarchy=self.hierarchy, cfg=self.cfg, state=self.state, output=self.output)
        if self.emission not in EMISSIONS:
            raise ValueError(f"emission must be one of {EMISSIONS}")
        if self.cfg.child_agg != "last" and self.groups_report:
            raise ValueError("groups that report have last values: child_agg must be 'last'")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self._step(batch, batch_id)
        finally:
            batch.unpersist()

    def _step(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tree = self.hierarchy() if callable(self.hierarchy) else self.hierarchy
        before = self._clock(spark, batch_id - 1)
        if self.by:
            accepted, clock = self._accept_by_source(batch, before, batch_id)
        else:
            newest = batch.agg(F.unix_micros(F.max("event_time"))).first()[0]
            clock = max((t for t in (before, newest) if t is not None), default=None)
            accepted = self._accept(batch, before)
        accepted = write_table(accepted, "accepted")
        earlier = self._load(spark, "values", batch_id - 1)
        merged = self._merge(accepted, earlier)
        open_until = F.unix_micros(window_end(self.cfg)) + F.lit(self.cfg.grace_period_ms * 1000)
        still_open = open_until > F.lit(clock).cast("bigint") if clock is not None else F.lit(True)

        if self.emission == "final":
            merged = write_table(merged, "merged")
            closed = merged.where(~still_open)
            if self.cfg.child_agg == "avg":
                closed = closed.withColumn("value_w", F.col("value_w") / F.col("readings"))
            self._emit(rollup_values(closed, tree, self.cfg), batch_id)
        else:
            log = self._new_updates(accepted, earlier, tree)
            if self.emission == "changelog":
                self._emit(log, batch_id)
            else:
                carried = self._load(spark, "entries", batch_id - 1)
                released, waiting = throttle(log, clock, self.cfg, carried)
                self._emit(released, batch_id)
                self._save(waiting, "entries", batch_id)
        self._save(merged.where(still_open), "values", batch_id)
        self._save(spark.range(1).select(F.lit(clock).cast("bigint").alias("clock")), "clock", batch_id)

    def _accept(self, batch: DataFrame, before: int | None) -> DataFrame:
        """Readings whose window was open at their arrival, with stream time."""
        carried = F.timestamp_micros(F.lit(before).cast("bigint"))
        timed = with_stream_time(batch).withColumn(
            "stream_time", F.greatest("stream_time", carried)
        )
        open_until = F.unix_micros(window_end(self.cfg)) + F.lit(self.cfg.grace_period_ms * 1000)
        return with_window_start(timed, self.cfg).where(open_until > F.unix_micros("stream_time"))

    def _accept_by_source(
        self, batch: DataFrame, released: int | None, batch_id: int
    ) -> tuple[DataFrame, int | None]:
        """As _accept, each source by its own clock, and the time that all have reached.

        Sources keep the number they got when they first reported; with it arrival numbers are
        unique over all sources and batches.
        """
        spark, by = batch.sparkSession, list(self.by)
        known = self._load(spark, "sources", batch_id - 1)
        rows = [] if known is None else known.collect()
        numbers = {tuple(r[c] for c in by): r["source_no"] for r in rows}
        clocks = {tuple(r[c] for c in by): r["clock"] for r in rows}
        own = batch.groupBy(*by).agg(F.unix_micros(F.max("event_time")).alias("newest"))
        after = dict(clocks)
        for r in sorted(own.collect(), key=repr):
            name = tuple(r[c] for c in by)
            numbers.setdefault(name, len(numbers))
            after[name] = max(t for t in (r["newest"], clocks.get(name)) if t is not None)
        if len(numbers) > _SOURCES:
            raise ValueError(f"more than {_SOURCES} sources")
        schema = T.StructType([*(batch.schema[c] for c in by), *_SOURCE_STATE])

        def table(values: dict[tuple, int]) -> DataFrame:
            return spark.createDataFrame(
                [(*name, numbers[name], values.get(name)) for name in numbers], schema
            )

        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
        numbered = write_table(
            batch.alias("r").join(F.broadcast(table(clocks).alias("s")), same).select(
                *[f"r.{c}" for c in batch.columns if c != "arrival_seq"],
                (F.col("r.arrival_seq") * _SOURCES + F.col("s.source_no")).alias("arrival_seq"),
                F.col("s.clock").alias("_carried"),
            ),
            "numbered",
        )
        timed = with_stream_time(numbered, self.by).withColumn(
            "stream_time", F.greatest("stream_time", F.timestamp_micros("_carried"))
        )
        if self.emission == "throttled":
            timed = with_release_time(write_table(timed, "timed"), self.by, clocks, released)
        accepted = accepted_readings(timed, self.cfg)
        if self.emission == "throttled":
            accepted = accepted.withColumn("stream_time", F.col("release_time"))
        self._save(table(after), "sources", batch_id)
        reached = min(after.values()) if len(after) >= self.sources else None
        return accepted, max((t for t in (released, reached) if t is not None), default=None)

    def _merge(self, accepted: DataFrame, earlier: DataFrame | None) -> DataFrame:
        """What each sensor has come to per window, over this and all earlier batches.

        value_w is the last, largest or smallest value or the sum of all, of so many readings.
        """
        columns = [
            "window_start", "identifier", "payload_ts_ms", "arrival_seq", "value_w", "event_time"
        ]
        rows = accepted.select(*columns, F.lit(1).cast("bigint").alias("readings"))
        if earlier is not None:
            rows = rows.unionByName(earlier.select(*columns, "readings"))
        agg = self.cfg.child_agg
        if agg == "last":
            value = F.max_by("value_w", replay_order())
        elif agg in ("max", "min"):
            value = (F.max if agg == "max" else F.min)("value_w")
        else:
            value = from_summable(F.sum(summable(F.col("value_w"), self.cfg)), self.cfg)
        return rows.groupBy("window_start", "identifier").agg(
            F.max("payload_ts_ms").alias("payload_ts_ms"),
            F.max_by("arrival_seq", replay_order()).alias("arrival_seq"),
            value.alias("value_w"),
            F.max("event_time").alias("event_time"),
            F.sum("readings").alias("readings"),
        )

    def _new_updates(
        self, accepted: DataFrame, earlier: DataFrame | None, tree: Hierarchy
    ) -> DataFrame:
        """Changelog of this batch; carried values set the scene but cause no rows."""
        rows = accepted.select(
            "window_start", "identifier", "payload_ts_ms", "arrival_seq", "value_w",
            "event_time", "stream_time", F.lit(1).cast("bigint").alias("readings"),
        )
        if earlier is not None:
            rows = rows.unionByName(earlier, allowMissingColumns=True)
        follow = changelog_by_height if self.groups_report else aggregate_changelog
        log = follow(write_table(rows, "rows"), tree, self.cfg)
        return log.where(F.col("stream_time").isNotNull())

    def _emit(self, results: DataFrame, batch_id: int) -> None:
        folder = f"{self.output}/batch_id={batch_id}"
        results.write.mode("overwrite").parquet(folder)
        if self.publish is not None:
            self.publish(results.sparkSession.read.schema(results.schema).parquet(folder), batch_id)

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.state}/{name}/batch_id={batch_id}"

    def _save(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        folder = self._folder(name, batch_id)
        df.write.mode("overwrite").parquet(folder)
        return df.sparkSession.read.schema(df.schema).parquet(folder)

    def _load(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame | None:
        if batch_id < 0:
            return None
        df = spark.read.parquet(self._folder(name, batch_id))
        if name == "values":
            seq = F.col("arrival_seq")
            df = df.withColumn(
                "arrival_seq", F.when(seq >= 0, seq - F.lit(_EARLIER)).otherwise(seq)
            )
        return df

    def _clock(self, spark: SparkSession, batch_id: int) -> int | None:
        state = self._load(spark, "clock", batch_id)
        return None if state is None else state.first()["clock"]


def incremental_writer(
    readings: DataFrame, rollup: IncrementalRollup, checkpoint: str
) -> DataStreamWriter:
    """Streaming query that runs the roll-up; start it with the trigger of your choice."""
    require(readings=readings, checkpoint=checkpoint)
    return readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(rollup)
