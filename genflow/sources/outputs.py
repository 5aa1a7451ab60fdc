"""Outputs that exist already."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession

from ..storage import stored

#: Names a listing task hands on at once, and tasks a level is dealt over at most.
LISTED_ROWS, LISTING_TASKS = 10_000, 1000


def location(path: str) -> str:
    """A folder as a file system URI."""
    return path if "://" in path else "file://" + posixpath.abspath(path.removeprefix("file:"))


def _entries(fs: FileSystem, folder: str) -> Iterator[tuple[str, FileType]]:
    """Name and kind of what is in a folder; none if it has gone. A local folder is never held whole."""
    if isinstance(fs, LocalFileSystem):
        try:
            with os.scandir(folder) as found:
                for e in found:
                    yield e.name, FileType.Directory if e.is_dir() else FileType.File if e.is_file() else FileType.Unknown
        except FileNotFoundError:
            return
    else:
        for info in fs.get_file_info(FileSelector(folder, allow_not_found=True)):
            yield info.base_name, info.type


def _level(root: str, batch_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                paths, kinds = [], []
                for name, kind in _entries(fs, posixpath.join(base, folder)):
                    if kind in (FileType.File, FileType.Directory):
                        paths.append(posixpath.join(folder, name))
                        kinds.append(kind == FileType.Directory)
                    if len(paths) >= batch_rows:
                        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(kinds)], names=["path", "folder"])
                        paths, kinds = [], []
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(kinds, pa.bool_())], names=["path", "folder"])
    return run


def list_outputs(spark: SparkSession, output_dir: str, batch_rows: int = LISTED_ROWS) -> DataFrame:
    """Relative path of every file below ``output_dir``, whatever its name; contents are not read.

    The tree is walked level by level: the folders of a level are rows of a
    stored table, dealt over the tasks that list the next one. So one deep
    subtree spreads as well as many shallow ones, a flat folder goes on in
    batches, and the driver sees a count per level only. A folder that goes
    meanwhile has no files; a missing ``output_dir`` is an error.
    """
    root = location(output_dir)
    fs, base = FileSystem.from_uri(root)
    if fs.get_file_info(base).type != FileType.Directory:
        raise FileNotFoundError(f"no folder {output_dir}")
    files, folders = None, spark.createDataFrame([("",)], "path string")
    tasks = 1
    while tasks:
        level = stored(folders.repartition(tasks).mapInArrow(_level(root, batch_rows), "path string, folder boolean"), "listing")
        found = level.where("not folder").select("path")
        files = found if files is None else files.unionByName(found)
        folders = level.where("folder").select("path")
        tasks = min(folders.count(), LISTING_TASKS)
    return files


def read_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """Relative paths recorded by the blob writer: the scalable stand-in for a listing."""
    return spark.read.parquet(*paths).where("error is null").select("path")
