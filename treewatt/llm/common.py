"""Helpers shared by the text operators: scratch tables, whole files, text columns."""

from __future__ import annotations

import ctypes
import posixpath
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treewatt.functions.tables import new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, UPPER.lower())


class Scratch:
    """Tables of one run below the folder that the session names for shared files.

    Everything is written once, under a name of its own, so a lost executor repeats its
    tasks from files. drop() removes a table that nothing will read again.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = new_path(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def file_system(uri: str):
    """File system and path of a URI or an absolute path, for use inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file that is written bit by bit and put in place in one step.

    A task that is run again, or twice at once, writes the same content to a name of its
    own and renames it, so readers see a whole file or none.
    """

    def __init__(self, uri: str):
        self.system, self.path = file_system(uri)
        self.system.create_dir(posixpath.dirname(self.path), recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.stream = self.system.open_output_stream(self.part)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def place(self) -> None:
        from pyarrow import fs

        self.stream.close()
        if self.system.get_file_info(self.path).type != fs.FileType.NotFound:
            self.system.delete_file(self.path)
        self.system.move(self.part, self.path)


def kept_with_text(
    df: DataFrame, keep: list, text_col: str
) -> tuple[DataFrame, Callable[[pa.RecordBatch], pa.Array]]:
    """(keep, body): a struct of columns and the text, and how a task gets at the texts.

    Where all columns are kept the text is among them, and body is left out, so that it
    travels once.
    """
    rows = df.select(F.struct(*keep).alias("keep"), F.col(text_col).alias("body"))
    if keep != ["*"]:
        return rows, lambda batch: batch.column(1)
    place = df.columns.index(text_col)
    return rows.drop("body"), lambda batch: batch.column(0).field(place)


_HELD: dict[tuple, object] = {}


def held_in_worker(key: tuple, make):
    """What make() gives, kept in this worker process until another key is asked for.

    Workers outlive their tasks, so tables of known words need not be learnt anew; with
    one place for all operators their memory does not add up.
    """
    if key not in _HELD:
        let_go_in_worker()
        _HELD[key] = make()
    return _HELD[key]


def let_go_in_worker() -> None:
    """Frees what held_in_worker keeps, and gives the memory back to the system; for operators
    that need the room."""
    if _HELD:
        _HELD.clear()
        give_back_memory()


def give_back_memory() -> None:
    """Gives freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
