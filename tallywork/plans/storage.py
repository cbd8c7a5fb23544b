"""Intermediate tables that outlive executors."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local master without the setting gets a fresh temporary folder; a cluster without it is an
    error, since a machine's own folder is not visible to the other executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallywork-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application has written; a missing one is no error."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def application_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one; it goes when the application ends."""
    path = f"{shared_folder(spark)}/{spark.conf.get('spark.app.id')}"
    place, files = _file_system(spark, path)
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return path


def new_folder(spark: SparkSession, label: str) -> str:
    """A new path under the application's own folder."""
    path = f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block what operators have stored in it.

    For long applications: results that were built in the block must be read or written in it.
    """
    mark = _scope.set([])
    try:
        yield
    finally:
        paths = _scope.get()
        _scope.reset(mark)
        for path in paths:
            remove(spark, path)


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``durable``, and the folder, for callers that ``remove`` it once nothing reads it."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, and freezes values that a recomputed task could draw differently, such as
    the partition a row lands in after range partitioning.
    """
    return stored(df, label)[0]
