"""New task files as a stream; each output is made once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.naming import expected_output
from ..storage import delete, folders, stored, temporary_tables

MANIFEST = "path string, index bigint, batch bigint"
#: Folders that paths are dealt into by hash, and files of one after which it is merged.
BUCKETS, MERGE_AFTER = 256, 8


def _bucket(path: str, buckets: int):
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, manifest_path: str, names: list[str]) -> DataFrame:
    paths = [f"{manifest_path}/{n}" for n in names]
    return spark.read.schema(MANIFEST).parquet(*paths) if paths else spark.createDataFrame([], MANIFEST)


def read_stream_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """Every output made so far, once: path, index and the micro-batch that made it."""
    rows = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(manifest_path)
    return rows.groupBy("path").agg(F.min_by(F.struct("index", "batch"), F.col("batch")).alias("r")).select("path", "r.*")


def _merge(spark: SparkSession, manifest_path: str, name: str, batch_id: int, merge_after: int) -> None:
    """One file folder for all that earlier micro-batches wrote into a bucket, if they are many. A crash in between leaves rows twice, which no reader minds."""
    parts = [p for p in folders(spark, f"{manifest_path}/{name}") if int(p.split("=")[1]) < batch_id]
    if len(parts) <= merge_after:
        return
    target = f"upto={batch_id - 1:012d}"
    rows = _read(spark, manifest_path, [f"{name}/{p}" for p in parts if p != target])
    rows.dropDuplicates(["path"]).coalesce(1).write.mode("overwrite").parquet(f"{manifest_path}/{name}/{target}")
    for part in parts:
        if part != target:
            delete(spark, f"{manifest_path}/{name}/{part}")


def stream_resume(df: DataFrame, score: Callable[[DataFrame], DataFrame], manifest_path: str, checkpoint: str,
                  name_col: str | None = None, buckets: int = BUCKETS, merge_after: int = MERGE_AFTER):
    """Score new tasks whose output is not in the manifest, then add them to it.

    ``score`` takes pending tasks (``expected``, ``index``, ...) and writes their
    outputs, returning the rows that were made. Copies inside a micro-batch
    collapse, and a replayed batch replaces its own manifest rows.

    The manifest is dealt into ``buckets`` by the hash of the path. A
    micro-batch reads the buckets its own paths fall into and no other, and a
    bucket that it touches is merged once many micro-batches have written to it,
    so the files it reads do not grow with the history. Read the whole with
    :func:`read_stream_manifest`; ``buckets`` must stay the same for a manifest.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with temporary_tables():
            named = batch.withColumn("expected", expected_output("index", name_col))
            row = F.struct(*[c for c in named.columns if c != "expected"])
            once = stored(named.groupBy("expected").agg(F.min_by(row, F.col("index")).alias("r")).select("expected", "r.*"), "tasks")
            touched = {r["b"] for r in once.select(_bucket("expected", buckets).alias("b")).distinct().collect()}
            there = [n for n in folders(spark, manifest_path) if n.startswith("bucket=") and int(n.split("=")[1]) in touched]
            for name in there:
                _merge(spark, manifest_path, name, batch_id, merge_after)
            parts = [f"{n}/{p}" for n in there for p in folders(spark, f"{manifest_path}/{n}")]
            done = _read(spark, manifest_path, parts).where(F.col("batch") != batch_id).select(F.col("path").alias("expected"))
            made = score(once.join(done, "expected", "left_anti"))
            out = made.select(F.col("expected").alias("path"), F.col("index").cast("bigint").alias("index"), F.lit(batch_id).cast("bigint").alias("batch"))
            dealt = out.select("*", _bucket("path", buckets).alias("bucket"), F.lit(f"{batch_id:012d}").alias("part"))
            (dealt.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "part").parquet(manifest_path))

    return (df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
