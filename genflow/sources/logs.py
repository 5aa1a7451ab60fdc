"""Worker log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.logs import parse_log_line


def read_worker_logs(spark: SparkSession, log_dir: str) -> DataFrame:
    """Every ``process_0.log`` and ``node{n}_process{p}.log`` with its parsed lines.

    Node and process come from the file name; lines of another shape (the rest
    of a traceback) keep their text in ``raw``.
    """
    lines = spark.read.text(log_dir.rstrip("/") + "/*process*.log")
    name = F.col("_metadata.file_name")
    node = F.regexp_extract(name, r"^node(\d+)_process\d+\.log$", 1).try_cast("int")
    process = F.regexp_extract(name, r"process_?(\d+)\.log$", 1).try_cast("int")
    return lines.select(
        F.coalesce(node, F.lit(0)).alias("node"), process.alias("file_process"), name.alias("file"),
        parse_log_line("value").alias("line")).select("node", "file_process", "file", "line.*")
