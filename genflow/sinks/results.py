"""Result tables and audit rows."""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def result_columns(df: DataFrame, fieldnames: Sequence[str] | None = None) -> DataFrame:
    """The given columns in order, else all in sorted order; missing ones are empty, extra ones go."""
    names = sorted(df.columns) if fieldnames is None else list(fieldnames)
    return df.select(*[
        F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")).alias(n) if n in df.columns else F.lit("").alias(n)
        for n in names
    ])


def write_results(df: DataFrame, path: str, fieldnames: Sequence[str] | None = None) -> bool:
    """CSV with a header; nothing is written (False) when there are no rows."""
    if df.isEmpty():
        return False
    result_columns(df, fieldnames).write.mode("overwrite").csv(
        path, header=True, emptyValue="", nullValue="", quote='"', escape='"')
    return True


def shard_suffix(node: Column, process: Column, nodes: int, procs: int) -> Column:
    """'_node0_process1', with only the levels that have more than one member."""
    parts = []
    if nodes > 1:
        parts.append(F.concat(F.lit("node"), node.cast("string")))
    if procs > 1:
        parts.append(F.concat(F.lit("process"), process.cast("string")))
    return F.concat(F.lit("_"), F.concat_ws("_", *parts)) if parts else F.lit("")


def merge_results(frames: Sequence[DataFrame]) -> DataFrame:
    """All shard results in one table; columns are matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def save_progress(df: DataFrame, path: str, run_id: str, key: Sequence[str] = ("run_id", "index")) -> None:
    """Append finished rows of a run; :func:`read_progress` takes the latest save of a row."""
    df.withColumn("run_id", F.lit(run_id)).withColumn("_saved", F.lit(time.time_ns())).write.mode("append").partitionBy("run_id").parquet(path)


def read_progress(spark, path: str, key: Sequence[str] = ("run_id", "index")) -> DataFrame:
    """Finished rows, one per (run, index): the latest save, so that every read gives the same rows."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    rest = [c for c in df.columns if c not in (*key, "_saved")]
    # Two rows of one save are told apart by what they hold.
    order = F.struct("_saved", F.xxhash64(*rest))
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row_kept")).select(*key, "_row_kept.*")


AUDIT_COLUMNS = ("ts", "model", "n_images", "original", "enhanced", "raw", "error", "mode", "temperature")


def enhance_audit(df: DataFrame, model: str, mode: str = "api", temperature: float | None = None) -> DataFrame:
    """One audit row per rewrite; the error reads 'None' when there was none."""
    return df.select(
        F.current_timestamp().alias("ts"), F.lit(model).alias("model"),
        F.coalesce(F.col("n_images"), F.lit(0)).alias("n_images"), F.col("original"), F.col("enhanced"),
        F.coalesce(F.nullif(F.col("raw"), F.lit("")), F.lit("<empty>")).alias("raw"),
        F.coalesce(F.col("error"), F.lit("None")).alias("error"),
        F.lit(mode).alias("mode"), F.lit(temperature).cast("double").alias("temperature"))


def write_enhance_audit(df: DataFrame, path: str, run_id: str) -> None:
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
