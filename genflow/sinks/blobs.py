"""Writing bytes to named files, and the manifest of what was written."""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

MANIFEST_SCHEMA = "path string, length bigint, md5 string, error string"


def _save(fs, root: str, path: str, data: bytes) -> None:
    target = posixpath.normpath(posixpath.join(root, path))
    if not target.startswith(root.rstrip("/") + "/"):
        raise ValueError("the path leaves the output folder")
    fs.create_dir(posixpath.dirname(target), recursive=True)
    # Renamed into place, so a file that exists is always whole.
    temporary = posixpath.join(posixpath.dirname(target), f".{uuid.uuid4().hex}.tmp")
    with fs.open_output_stream(temporary) as out:
        out.write(data)
    fs.move(temporary, target)


def write_named_blobs(df: DataFrame, root: str, path: str = "path", data: str = "data") -> DataFrame:
    """Save each row's bytes below ``root`` (a folder or file system URI all executors reach).

    Returns the manifest rows (path, length, md5, error); store them before
    using them twice, as every evaluation writes again. Rewriting a path gives
    the same file, so repeated tasks do no harm.
    """
    location = root if "://" in root else "file://" + posixpath.abspath(root)

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(location)
        for batch in batches:
            rows = []
            for name, blob in zip(batch["path"], batch["data"]):
                try:
                    _save(fs, base, name, bytes(blob))
                    rows.append((name, len(blob), hashlib.md5(blob).hexdigest(), None))
                except Exception as error:
                    rows.append((name, None, None, f"{type(error).__name__}: {error}"))
            out = pd.DataFrame(rows, columns=["path", "length", "md5", "error"])
            yield out.astype({"length": "Int64"})

    return df.select(F.col(path).alias("path"), F.col(data).alias("data")).mapInPandas(save, MANIFEST_SCHEMA)
