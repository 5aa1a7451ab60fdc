"""Summaries of runs, shards and key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import col_of

# Key categories in match order, with how each is recognised.
KEY_CATEGORIES = (
    ("lora", "contains_any_case", "lora"),
    ("connector", "contains", "connector"),
    ("projector", "contains", "projector"),
    ("meta_queries", "contains", "meta_queries"),
    ("transformer", "prefix", "transformer."),
    ("lmm", "prefix", "lmm."),
    ("vae", "prefix", "vae."),
)
OTHER_CATEGORY = "other"


def key_category(key) -> Column:
    """Category of a key by the first rule that matches."""
    key = col_of(key)
    tests = {
        "contains_any_case": lambda text: F.contains(F.lower(key), F.lit(text)),
        "contains": lambda text: F.contains(key, F.lit(text)),
        "prefix": key.startswith,
    }
    return reduce(
        lambda rest, rule: F.when(tests[rule[1]](rule[2]), F.lit(rule[0])).otherwise(rest),
        reversed(KEY_CATEGORIES), F.lit(OTHER_CATEGORY))


def key_categories(df: DataFrame, key: str = "key", by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct keys per category. Members stay rows (see :func:`key_category`), never one list."""
    keys = df.select(*by, F.col(key).alias("_k")).distinct()
    return keys.groupBy(*by, key_category("_k").alias("category")).agg(F.count(F.lit(1)).alias("keys"))


def run_summary(results: DataFrame, ok: Column) -> DataFrame:
    """One row: successes, failures, exit code."""
    good = F.coalesce(ok, F.lit(False))
    counts = results.agg(F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"))
    return counts.withColumn("exit_code", F.when(F.col("failed") == 0, F.lit(0)).otherwise(F.lit(1)))


def throughput(df: DataFrame, worker: str = "worker", ts: str = "ts") -> DataFrame:
    """Images per elapsed second for each worker and overall ('ALL'); null when no time passed."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rolled = df.rollup(worker).agg(
        F.grouping(worker).alias("_all"), F.count(F.lit(1)).alias("images"),
        (F.max(micros) - F.min(micros)).alias("elapsed_us"))
    rate = F.col("images") * F.lit(1e6) / F.nullif(F.col("elapsed_us"), F.lit(0).cast("bigint")).cast("double")
    return rolled.select(
        F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col(worker).cast("string")).alias("worker"),
        "images", "elapsed_us", rate.alias("images_per_second"))


def shard_progress(df: DataFrame, done: str = "_done") -> DataFrame:
    """Total, completed and pending rows per process, per node and overall (-1 marks a total)."""
    rolled = df.rollup("node", "process").agg(
        F.grouping("node").alias("_n"), F.grouping("process").alias("_p"),
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(done)).alias("completed"),
        F.count_if(~F.col(done)).alias("pending"))
    return rolled.select(
        F.when(F.col("_n") == 1, F.lit(-1)).otherwise(F.col("node")).cast("bigint").alias("node"),
        F.when(F.col("_p") == 1, F.lit(-1)).otherwise(F.col("process")).cast("bigint").alias("process"),
        "total", "completed", "pending")


def align_results(batch: DataFrame, results: DataFrame, key: tuple[str, ...] = ("_batch", "_slot")) -> DataFrame:
    """API results back on their tasks: the first image, or null for an error or an empty reply."""
    first = F.when(F.col("error").isNull(), F.try_element_at("images", F.lit(1)))
    replies = results.select(*key, first.alias("image"), F.col("error").alias("_error"))
    return batch.join(replies, list(key), "left").drop(*key)
