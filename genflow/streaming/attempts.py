"""Attempt logs as a stream: rates, errors, health and pacing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.logs import error_family
from ..operators.attempts import endpoint_health, health_state, paced_schedule, pacing_state
from ..storage import delete, temporary_tables
from .parts import MERGE_AFTER, read_parts, write_part

def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Windows need a TIMESTAMP; logs carry zone-less UTC times, so run the session in UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def rate_counts(df: DataFrame, window: str = "60 seconds", slide: str = "10 seconds") -> DataFrame:
    """Sends per endpoint in sliding windows, of a batch."""
    return df.groupBy(F.window("ts", window, slide).alias("w"), "endpoint").agg(F.count(F.lit(1)).alias("sends")).select(
        "endpoint", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "sends")


def error_counts(df: DataFrame, window: str = "1 minute") -> DataFrame:
    """Errors per minute and code, of a batch."""
    return df.where(F.col("code").isNotNull()).groupBy(F.window("ts", window).alias("w"), "code").agg(F.count(F.lit(1)).alias("errors")).select(
        F.col("w.start").alias("start"), "code", error_family("code").alias("family"), "errors")


def merged_rates(counts: DataFrame) -> DataFrame:
    return counts.groupBy("endpoint", "start", "end").agg(F.sum("sends").alias("sends"))


def merged_errors(counts: DataFrame) -> DataFrame:
    return counts.groupBy("start", "code", "family").agg(F.sum("errors").alias("errors"))


def _counted(df: DataFrame, count: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
             merge_after: int):
    """Count each micro-batch by itself and keep the counts as parts (:mod:`.parts`).

    No counts are held in memory between micro-batches, and a row counts in its
    window however late it comes.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        write_part(count(batch), path, batch_id, merge, merge_after)

    return (df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_rate(df: DataFrame, path: str, checkpoint: str, window: str = "60 seconds", slide: str = "10 seconds", merge_after: int = MERGE_AFTER):
    """Count sends per endpoint in sliding windows; read them with :func:`read_rate`."""
    return _counted(df, lambda rows: rate_counts(rows, window, slide), merged_rates, path, checkpoint, merge_after)


def read_rate(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, merged_rates)


def stream_errors(df: DataFrame, path: str, checkpoint: str, window: str = "1 minute", merge_after: int = MERGE_AFTER):
    """Count errors per minute and code; read them with :func:`read_errors`."""
    return _counted(df, lambda rows: error_counts(rows, window), merged_errors, path, checkpoint, merge_after)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, merged_errors)


def _carried(df: DataFrame, step: Callable[[DataFrame, DataFrame | None], DataFrame],
             summary: Callable[[DataFrame], DataFrame], merge_on: list[str], out_path: str, state_path: str,
             checkpoint: str):
    """Run ``step`` on each micro-batch with the state the batches before it left.

    A keyed stateful operator would put a whole endpoint into one task; the
    batch operators do not. State is a small table per micro-batch, written
    after the rows, so a replayed batch starts from the same state; only the
    last two are kept. What the step stores on its way goes with the batch.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = spark.read.parquet(f"{state_path}/batch={batch_id - 1}") if batch_id > 0 else None
        rows_path = f"{out_path}/batch={batch_id}"
        with temporary_tables():
            step(batch, state).write.mode("overwrite").parquet(rows_path)
        rows = spark.read.parquet(rows_path)
        after = summary(rows)
        if state is not None:
            kept = state.join(after.select(*merge_on), _same(state, after, merge_on), "left_anti")
            after = after.unionByName(kept)
        after.write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")
        if batch_id > 1:
            delete(spark, f"{state_path}/batch={batch_id - 2}")

    return (df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _same(left: DataFrame, right: DataFrame, columns: list[str]):
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def stream_health(df: DataFrame, out_path: str, state_path: str, checkpoint: str):
    """:func:`endpoint_health` over a stream.

    Rows are ordered inside a micro-batch; a row that arrives in a later batch
    counts after everything before it.
    """
    return _carried(df, lambda rows, state: endpoint_health(rows, start=state), health_state, ["endpoint"],
                    out_path, state_path, checkpoint)


def stream_pacing(df: DataFrame, endpoints: DataFrame, out_path: str, state_path: str, checkpoint: str):
    """:func:`paced_schedule` over a stream; the state is calls made and one level per slot."""
    return _carried(df, lambda rows, state: paced_schedule(rows, endpoints, start=state), pacing_state,
                    ["endpoint", "slot"], out_path, state_path, checkpoint)


def read_log_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000, **options) -> DataFrame:
    return (spark.readStream.schema(schema).options(maxFilesPerTrigger=files_per_trigger, **options).parquet(path))
