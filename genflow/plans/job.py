"""Whole jobs: plan what is left, score it, record the results."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.attempts import RetryPolicy
from ..functions.naming import expected_output
from ..operators.failover import Endpoint
from ..operators.order import positions, source_positions
from ..operators.params import with_capabilities
from ..operators.resume import filter_rows, output_collisions, pending
from ..operators.scoring import ATTEMPTS, ERROR, score_batches
from ..operators.shards import cannot_batch, expand_samples, pack_batches, shard_balanced, shard_ceil
from ..sinks.blobs import write_named_blobs
from ..storage import stored

SHARD_RULES = {"balanced": shard_balanced, "ceil": shard_ceil}


@dataclass(frozen=True)
class PlanOptions:
    """How a run is cut up; ``n`` images per task."""

    nodes: int = 1
    procs: int = 1
    batch_size: int = 1
    rule: str = "balanced"
    n: int = 1
    name_col: str | None = None
    model_col: str | None = None
    image_col: str | None = None  # batches share one image
    collisions: str = "keep"  # or "raise", where two tasks would write one file
    rows: str | None = None
    resume: bool = True
    strict: bool = False


def located(tasks: DataFrame) -> DataFrame:
    """File and row of each task; a table made in place counts as one file in index order."""
    if "_file" not in tasks.columns:
        tasks = tasks.withColumn("_file", F.lit(""))
    if "_row" not in tasks.columns:
        tasks = tasks.withColumn("_row", F.col("_pos" if "_pos" in tasks.columns else "index"))
    return tasks if "_pos" in tasks.columns else tasks.withColumn("_pos", F.col("_row"))


def plan_tasks(tasks: DataFrame, outputs: DataFrame | None, options: PlanOptions = PlanOptions()) -> DataFrame:
    """What is left to do, by node, process and batch.

    ``tasks`` comes from one of the readers (``_file``, ``_row``, ``_pos``).
    Row filters come first, then finished tasks go, then positions are counted
    anew and cut up by arithmetic. All shards share one plan: write it once.
    Only key columns are needed here; join the wide ones at scoring time.
    ``strict`` gives every image of a task its own row (``sub``) and checks each
    of them, instead of one row per task that is done when its first image is.

    What is left is stored before it is counted and numbered, so outputs that
    appear meanwhile cannot shift positions and names are made once.
    """
    if options.collisions not in ("keep", "raise"):
        raise ValueError("collisions must be 'keep' or 'raise'")
    from_files = "_file" in tasks.columns and "_row" in tasks.columns
    tasks = located(tasks)
    if options.rows:
        tasks = filter_rows(tasks, options.rows)
    if options.strict and options.n > 1:
        tasks = expand_samples(tasks, options.n)
        named = tasks.withColumn("expected", expected_output("index", options.name_col, options.n, F.col("sub")))
        # One row per image, so the order needs the image number as well.
        named = named.withColumn("_at_row", F.col("_row") * options.n + F.col("sub"))
    else:
        named = tasks.withColumn("_at_row", F.col("_row")).withColumn("expected", expected_output("index", options.name_col, options.n))
    left = named if outputs is None else pending(named, outputs, resume=options.resume)
    left = stored(left.drop("_pos"), "left")
    if options.collisions == "raise":
        twice = output_collisions(left).orderBy("expected").limit(5).collect()
        if twice:
            raise ValueError("several tasks write the same file: " + ", ".join(r["expected"] for r in twice))
    if from_files:
        placed = source_positions(left, row="_at_row").drop("_at_row")
    else:  # any index, in any order, repeated or missing: equal rows are told apart by what they hold
        tied = left.withColumn("_tie", F.xxhash64(*left.columns))
        placed = positions(tied, ["_at_row", "_tie"], pos="_pos", size="_total").drop("_at_row", "_tie")
    sharded = SHARD_RULES[options.rule](placed, options.nodes, options.procs)
    single = None
    if options.model_col:
        sharded = with_capabilities(sharded, model_type=options.model_col)
        single = cannot_batch()
    return pack_batches(sharded, options.batch_size, single, [c for c in (options.model_col, options.image_col) if c])


KEYS = ("node", "process", "batch")
#: A chunk's work is written in so many parts at most, so that no task holds it whole.
CHUNK_PARTS = 8
COMMIT = "chunk bigint, step string, at timestamp"


def _work(plan: DataFrame, tasks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Plan rows with the columns to score, one row each whatever their indices.

    Rows read from files are found by file and row number. A table made in
    place has no such name for a row, so its plan carries the columns itself;
    where it does not, rows are found by index, null ones too, as long as no
    index occurs twice.
    """
    keys = ["index", "expected", *(["sub"] if "sub" in plan.columns else []), "_file", "_row"]
    wanted = plan.select(*keys, *KEYS, *[c for c in columns if c in plan.columns and c not in keys])
    missing = [c for c in columns if c not in wanted.columns]
    if not missing:
        return wanted
    if "_file" in tasks.columns and "_row" in tasks.columns:
        return wanted.join(tasks.select("_file", "_row", *missing), ["_file", "_row"])
    if not tasks.groupBy("index").count().where("count > 1").isEmpty():
        raise ValueError(f"an index occurs more than once: plan the tasks with their columns {missing}")
    wide = tasks.select(F.col("index").alias("_task_index"), *missing)
    return wanted.join(wide, F.col("index").eqNullSafe(F.col("_task_index"))).drop("_task_index")


def _commits(spark, run_path: str) -> set[tuple[int, str]]:
    """Steps done so far: one row per chunk and step."""
    return {(r["chunk"], r["step"]) for r in spark.read.schema(COMMIT).parquet(f"{run_path}/commits").collect()}


def _commit(spark, run_path: str, chunk: int, step: str) -> None:
    row = spark.range(1).select(F.lit(chunk).cast("bigint").alias("chunk"), F.lit(step).alias("step"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").parquet(f"{run_path}/commits")


def start_run(plan: DataFrame, tasks: DataFrame, results_path: str, columns: Sequence[str] = (), chunk_rows: int = 100_000) -> str:
    """Store the work of a plan once, cut into chunks, and return the run's folder.

    Whole batches are dealt into chunks of about ``chunk_rows`` rows, each a
    folder of its own, so a chunk is read without a look at any other.
    """
    spark = plan.sparkSession
    run_path = f"{results_path.rstrip('/')}/scores/{uuid.uuid4().hex}"
    chunks = max(1, -(-plan.count() // chunk_rows))
    dealt = F.xxhash64(*KEYS)
    work = _work(plan, tasks, columns).withColumn("chunk", F.pmod(dealt, F.lit(chunks)))
    spread = work.repartition("chunk", F.pmod(F.floor(dealt / chunks), F.lit(CHUNK_PARTS)))
    spread.write.partitionBy("chunk").parquet(f"{run_path}/work")
    work.limit(0).write.parquet(f"{run_path}/columns")
    spark.createDataFrame([], COMMIT).write.parquet(f"{run_path}/commits")
    return run_path


def finish_run(spark, run_path: str, factory: Callable[[], Callable], output_dir: str, results_path: str,
               batch_size: int = 1, threads: int = 1, policy: RetryPolicy | None = None, endpoints: Sequence[Endpoint] | None = None) -> DataFrame:
    """Score what a started run has left and return one result row per plan row.

    Each chunk is scored, written and committed, then saved, recorded in the
    manifest and committed again, before the next one starts. After a failure
    call this again: committed steps are not repeated, so no chunk whose
    scores were written is called twice.
    """
    manifest_path = results_path.rstrip("/") + "/manifest"
    schema = spark.read.parquet(f"{run_path}/columns").schema
    stored_work = spark.read.schema(schema).parquet(f"{run_path}/work")
    keys = [c for c in ("index", "expected", "sub", "_file", "_row") if c in stored_work.columns]
    chunks = [r["chunk"] for r in stored_work.select("chunk").distinct().orderBy("chunk").collect()]  # from folder names
    done = _commits(spark, run_path)
    for chunk in chunks:
        scored_path = f"{run_path}/scored/chunk={chunk}"
        if (chunk, "scored") not in done:
            mine = spark.read.schema(schema).option("basePath", f"{run_path}/work").parquet(f"{run_path}/work/chunk={chunk}").drop("chunk")
            made = score_batches(mine, factory, "image binary", batch_size, keys, KEYS, threads, policy=policy, endpoints=endpoints, log=True)
            made.write.mode("overwrite").parquet(scored_path)
            _commit(spark, run_path, chunk, "scored")
        if (chunk, "saved") not in done:
            saved = write_named_blobs(spark.read.parquet(scored_path).where(F.col(ERROR).isNull()), output_dir, "expected", "image")
            saved.write.mode("append").parquet(manifest_path)
            _commit(spark, run_path, chunk, "saved")
    if not chunks:
        empty = score_batches(stored_work.drop("chunk"), factory, "image binary", batch_size, keys, KEYS, log=True)
        empty.write.mode("overwrite").parquet(f"{run_path}/scored/chunk=0")
        write_named_blobs(spark.read.parquet(f"{run_path}/scored/chunk=0"), output_dir, "expected", "image").write.mode("append").parquet(manifest_path)
    scores = spark.read.parquet(f"{run_path}/scored").drop("chunk")
    # The manifest also holds earlier runs: a path is saved once any of them saved it.
    written = F.count_if(F.col("error").isNull()) > 0
    saved = spark.read.parquet(manifest_path).groupBy("path").agg(
        F.when(~written, F.max("error")).alias("_save_error"))
    outcome = scores.drop("image").join(saved, F.col("expected") == F.col("path"), "left")
    failed = F.coalesce(F.col(ERROR), F.col("_save_error"))
    return outcome.select(
        *[k for k in keys if k != "expected"], F.when(failed.isNull(), F.col("expected")).alias("output_image"), failed.alias(ERROR), ATTEMPTS)


def run_plan(plan: DataFrame, tasks: DataFrame, factory: Callable[[], Callable], output_dir: str, results_path: str,
             batch_size: int = 1, columns: Sequence[str] = (), threads: int = 1, chunk_rows: int = 100_000,
             policy: RetryPolicy | None = None, endpoints: Sequence[Endpoint] | None = None) -> DataFrame:
    """Score a stored plan, save the images, and return one result row per plan row, with its tries.

    Plan several images per task with ``strict``, one row each. The scorer's dicts carry ``image`` bytes. The work is
    stored once (:func:`start_run`), then done chunk by chunk (:func:`finish_run`). After a failure finish the run, or plan
    again against the manifest: recorded rows are not called again. Every run has a folder of its own below ``scores``,
    so no run touches another's.
    """
    run_path = start_run(plan, tasks, results_path, columns, chunk_rows)
    return finish_run(plan.sparkSession, run_path, factory, output_dir, results_path, batch_size, threads, policy, endpoints)
