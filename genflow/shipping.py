"""Make the package importable in Python workers."""

from __future__ import annotations

import importlib
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[tuple[str, str]] = set()


def ship(spark: SparkSession, *packages: str) -> None:
    """Send packages (this one by default) to the workers, once per application."""
    for name in packages or ("genflow",):
        mark = (spark.sparkContext.applicationId, name)
        if mark in _SHIPPED:
            continue
        root = os.path.dirname(os.path.abspath(importlib.import_module(name).__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="genflow-ship-"), f"{name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, files in os.walk(root):
                for file in files:
                    if file.endswith(".py"):
                        full = os.path.join(folder, file)
                        out.write(full, os.path.join(name, os.path.relpath(full, root)))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(mark)
