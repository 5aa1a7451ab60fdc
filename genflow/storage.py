"""The shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="genflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_STORED: dict[str, SparkSession] = {}


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that any file system of the session can reach."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside ``path``, sorted; none if it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()) if system.exists(target) else []


def drop_stored() -> None:
    """Delete all tables that :func:`stored` wrote, once what reads them is done; also done when the driver's Python ends."""
    while _STORED:
        path, spark = _STORED.popitem()
        try:
            delete(spark, path)
        except Exception:  # the session has ended: its shared folder is the user's to empty
            _STORED.clear()


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Delete what :func:`stored` writes inside the block when it ends: for long drivers, whose results are written by then."""
    before = set(_STORED)
    try:
        yield
    finally:
        for path in set(_STORED) - before:
            delete(_STORED.pop(path), path)


atexit.register(drop_stored)


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: later stages, retries and lost executors read the files.
    Each partition becomes one file with its rows in order. The table stays
    until the end of a :func:`temporary_tables` block, :func:`drop_stored` or
    the end of the driver's Python.
    """
    path = new_path(df.sparkSession, label)
    _STORED[path] = df.sparkSession
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
