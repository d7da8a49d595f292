"""Intermediate results as tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ARROW_BATCH = "2m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_made: ContextVar[list[str] | None] = ContextVar("folders_of_the_block", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the session's checkpoint folder.

    Only a local session without either may use a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="metacurate-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the shared folder that no other run uses."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Delete at the end of the block every folder that it made under the shared folder.

    Gives the list of these folders, newest last; those taken off it stay. What is
    computed inside has to be written by the end of the block, since a DataFrame
    that still reads a deleted table fails.
    """
    folders: list[str] = []
    token = _made.set(folders)
    try:
        yield folders
    finally:
        _made.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, size: str = ARROW_BATCH) -> Iterator[None]:
    """Python functions that run inside the block get Arrow batches of some ``size``, unless the session has a size of its own.

    Spark's default, 64 MB, is held by the executor and by its Python worker, for each task.
    """
    own = spark.conf.get(_BATCH_KEY, None)
    if own is None:
        spark.conf.set(_BATCH_KEY, size)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_BATCH_KEY)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """Compute ``df`` once, into a table of the shared folder, and read it from there.

    Nothing above is computed twice, the loss of an executor costs nothing but
    the read, and the planner knows the size of the result. Python functions get
    small batches.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with arrow_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
