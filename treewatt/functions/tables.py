"""Written intermediate tables, and joins that broadcast only a counted side."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables that cut lineage: what the session names, nothing else.

    Only a local master without the setting gets a temporary folder of its own;
    on a cluster a machine-local folder would vanish with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="treewatt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/treewatt/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs run inside, put back as it was afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_written = threading.local()


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, the tables that write_table made inside in this thread.

    For steps whose results are written elsewhere by then, such as one micro-batch.
    """
    outer = getattr(_written, "paths", None)
    _written.paths = []
    try:
        yield
    finally:
        for path in _written.paths:
            delete(spark, path)
        _written.paths = outer


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and return the reader of what was written.

    Computed once (a checkpoint computes twice), columnar when read back, and its
    file sizes give the optimiser true statistics.
    """
    path = new_path(df.sparkSession, label)
    if getattr(_written, "paths", None) is not None:
        _written.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(dimension: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast if the counted rows allow it; otherwise leave the join to
    the shuffle path, where AQE splits skewed partitions of the other side."""
    return F.broadcast(dimension) if rows <= limit else dimension
