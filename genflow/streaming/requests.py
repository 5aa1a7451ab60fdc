"""Request files as a stream: accepted work and rejects to two sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.requests import checked_requests
from ..operators.shards import expand_samples
from ..sources.requests import parse_request


def read_request_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New text files of JSON bodies, with the kind taken from the body itself."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.withColumnRenamed("value", "body")


def accept_requests(df: DataFrame, mode: str | None = None) -> DataFrame:
    """Checked requests of a batch or a stream; ``body`` and ``kind`` in, status columns out."""
    parsed = df.withColumn("request", parse_request("body"))
    return checked_requests(parsed, mode=mode)


def stream_requests(df: DataFrame, accepted_path: str, rejected_path: str, checkpoint: str, mode: str | None = None):
    """Start a query that appends one row per image to make, and one per rejected request.

    Each micro-batch overwrites its own ``batch`` partition, so a replayed batch
    changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        checked = accept_requests(batch, mode).withColumn("batch", F.lit(batch_id))
        good = expand_samples(checked.where("_status = 200"), "_n")
        bad = checked.where("_status <> 200")
        for rows, path in ((good, accepted_path), (bad, rejected_path)):
            (rows.drop("request").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").parquet(path))

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
