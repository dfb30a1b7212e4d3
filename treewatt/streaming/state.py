"""Keyed tables that a stream carries on, at a cost that follows what a batch changes.

A table is a whole state and the changes of the batches since. Rows lie in buckets by the hash
of their key: a batch reads only the buckets that its own keys fall into, and writes only the
rows that it has changed. Every ``compact_every`` batches the rows that are still wanted are
written as a new whole state, and older folders are removed once no batch can be run again from
them, so the number of folders does not grow.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treewatt.functions.tables import delete

BUCKETS = 16
COMPACT_EVERY = 8


@dataclass(frozen=True)
class KeyedTable:
    root: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS
    compact_every: int = COMPACT_EVERY

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _base(self, batch_id: int) -> int:
        return batch_id - batch_id % self.compact_every

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/batch-{batch_id}"

    def _rows(self, spark: SparkSession, batch_id: int, buckets: list[int] | None) -> DataFrame:
        """All versions of rows, the number of their batch with them."""
        schema = f"{self.schema}, removed boolean, bucket int"
        frames = []
        for number in range(self._base(batch_id), batch_id + 1):
            part = spark.read.schema(schema).parquet(self._folder(number))
            if buckets is not None:
                part = part.where(F.col("bucket").isin(buckets))
            frames.append(part.drop("bucket").withColumn("_batch", F.lit(number)))
        return reduce(DataFrame.unionByName, frames)

    def _newest(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c not in (*self.keys, "_batch")]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*columns), "_batch").alias("_row"))
        kept = [c for c in columns if c != "removed"]
        return newest.where("NOT _row.removed").select(*self.keys, *[f"_row.{c}" for c in kept])

    def at(self, spark: SparkSession, batch_id: int) -> StateAt:
        """The table as a batch left it; batch -1 left nothing."""
        return StateAt(self, spark, batch_id)

    def save(self, changed: DataFrame, batch_id: int, wanted: Column | None = None) -> None:
        """Write what a batch has changed (rows with ``removed``, one a key); of a whole state
        only the rows that are wanted."""
        spark, rows = changed.sparkSession, changed
        if self._base(batch_id) == batch_id:
            if batch_id > 0:
                before = self._rows(spark, batch_id - 1, None)
                both = before.unionByName(changed.withColumn("_batch", F.lit(batch_id)))
                rows = self._newest(both).withColumn("removed", F.lit(False))
            if wanted is not None:
                rows = rows.where(wanted)
        (
            rows.withColumn("bucket", self._bucket())
            .repartition("bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(self._folder(batch_id))
        )

    def expire(self, spark: SparkSession, batch_id: int) -> None:
        """After a batch, which may be run again from the one before: remove the folders that
        neither of them needs."""
        first = self._base(batch_id - 1)
        if batch_id > 1 and first == batch_id - 1:
            for number in range(self._base(first - 1), first):
                delete(spark, self._folder(number))


class StateAt:
    """A keyed table as one batch left it."""

    def __init__(self, table: KeyedTable, spark: SparkSession, batch_id: int):
        self.table, self.spark, self.batch_id = table, spark, batch_id

    def of(self, asked: DataFrame) -> DataFrame:
        """Rows of the keys in asked, read from their buckets alone."""
        table = self.table
        if self.batch_id < 0:
            return self.spark.createDataFrame([], table.schema)
        keys = asked.select(*table.keys)
        numbers = [r[0] for r in keys.select(table._bucket().alias("b")).distinct().collect()]
        rows = table._rows(self.spark, self.batch_id, numbers)
        return table._newest(rows.join(keys, list(table.keys), "left_semi"))

    def whole(self) -> DataFrame:
        if self.batch_id < 0:
            return self.spark.createDataFrame([], self.table.schema)
        return self.table._newest(self.table._rows(self.spark, self.batch_id, None))
