"""Result and changelog sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from treewatt.config import require
from treewatt.functions.tables import write_table

_RESULT_KEY = ("window_start", "identifier")


def write_results(
    results: DataFrame,
    path: str,
    version: str | None = None,
    key: tuple[str, ...] = _RESULT_KEY,
) -> None:
    """Insert or update results, keyed by window and group, in a table by day of window.

    With a ``version`` column (without one named, ``arrival_seq`` if the results have it) each
    key keeps the row of its greatest version, of those written now and before: corrections
    may come together, in any order and more than once. Of equal versions the row written now
    stays. Without a version the row written now stays, and two for one key raise.

    Rows of other keys stay, also those of the same day, and writing the same results
    again leaves the table as it was. Only the days present in ``results`` are read and
    replaced; the new days are complete in the shared folder before any is replaced.
    """
    require(path=path)
    missing = sorted({"window_start", *key} - set(results.columns))
    if missing:
        raise ValueError(f"results lack key columns: {', '.join(missing)}")
    if version is None and "arrival_seq" in results.columns:
        version = "arrival_seq"
    spark = results.sparkSession
    dated = results.withColumn("window_date", F.to_date("window_start"))
    if version is None:
        new = write_table(dated, "results")
        if not new.groupBy(*key).count().where("count > 1").isEmpty():
            raise ValueError("several results for one key: name their version column")
    else:
        new = write_table(_newest(dated, key, [version]), "results")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder):
        days = new.select("window_date").distinct()
        old = spark.read.schema(new.schema).parquet(path).join(days, "window_date", "left_semi")
        both = new.withColumn("_now", F.lit(1)).unionByName(old.withColumn("_now", F.lit(0)))
        order = ["_now"] if version is None else [version, "_now"]
        new = write_table(_newest(both, key, order).drop("_now"), "days")
    (
        new.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_date")
        .parquet(path)
    )


def _newest(rows: DataFrame, key: tuple[str, ...], order: list[str]) -> DataFrame:
    """The row of each key that is last in this order."""
    others = [c for c in rows.columns if c not in key]
    return (
        rows.groupBy(*key)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in rows.columns])
    )


def to_bus(results: DataFrame) -> DataFrame:
    """Key and JSON value for a message bus: key is the group, window dropped."""
    body = F.struct(
        "identifier",
        F.col("timestamp_ms").alias("timestamp"),
        "count",
        F.col("sum_w").alias("sumInW"),
        F.col("average_w").alias("averageInW"),
    )
    return results.select(F.col("identifier").alias("key"), F.to_json(body).alias("value"))


def stream_batches(
    results: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Sink for one streaming result: each micro-batch replaces its own folder, so a
    batch that is run again after a failure leaves no second copy."""
    require(path=path, checkpoint=checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        results.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(put)
    )


def stream_to_bus(
    results: DataFrame, options: Mapping[str, str], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    """Kafka sink for one streaming result (needs the Kafka connector package)."""
    require(options=options, checkpoint=checkpoint)
    return (
        to_bus(results)
        .writeStream.format("kafka")
        .options(**options)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )


def bus_batches(options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """Publishes each batch of ``IncrementalRollup`` to Kafka (needs the connector)."""
    require(options=options)

    def put(results: DataFrame, batch_id: int) -> None:
        to_bus(results).write.format("kafka").options(**options).save()

    return put


def latest_per_window(results: DataFrame, version: str) -> DataFrame:
    """Upsert view of appended corrections: the newest row per (window, group)."""
    columns = [c for c in results.columns if c not in ("window_start", "identifier", version)]
    return results.groupBy("window_start", "identifier").agg(
        *[F.max_by(c, version).alias(c) for c in columns], F.max(version).alias(version)
    )
