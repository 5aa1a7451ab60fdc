"""Nodes, processes and batches as arithmetic on positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .order import positions


def _div(a: Column, b: Column) -> Column:
    return F.floor(a / F.greatest(b, F.lit(1).cast("bigint"))).cast("bigint")


def _ceil_split(pos: Column, n: Column, parts: int) -> tuple[Column, Column, Column]:
    """(part, position in part, part size) for chunks of ceil(n / parts)."""
    chunk = F.ceil(n / F.lit(parts)).cast("bigint")
    part = _div(pos, chunk)
    start = part * chunk
    return part, pos - start, F.least(chunk, n - start)


def _balanced_split(pos: Column, n: Column, parts: int) -> tuple[Column, Column, Column]:
    """(part, position in part, part size) with sizes that differ by one at most."""
    q = F.floor(n / F.lit(parts)).cast("bigint")
    m = F.pmod(n, F.lit(parts).cast("bigint"))
    longer = m * (q + 1)
    part = F.when(pos < longer, _div(pos, q + 1)).otherwise(m + _div(pos - longer, q))
    start = part * q + F.least(part, m)
    return part, pos - start, q + F.when(part < m, F.lit(1)).otherwise(F.lit(0))


def _shard(df: DataFrame, split, nodes: int, procs: int, pos: str, total: str) -> DataFrame:
    if nodes < 1 or procs < 1:
        raise ValueError("nodes and processes must be at least 1")
    node, at, size = split(F.col(pos), F.col(total), nodes)
    df = df.select("*", node.alias("node"), at.alias("_at"), size.alias("_size"))
    process, local, share = split(F.col("_at"), F.col("_size"), procs)
    return df.select("*", process.alias("process"), local.alias("shard_pos"), share.alias("shard_size")).drop(
        "_at", "_size")


def shard_ceil(df: DataFrame, nodes: int = 1, procs: int = 1, pos: str = "_pos", total: str = "_total") -> DataFrame:
    """Chunks of ceil(n/parts) over nodes, then over processes; the last ones may be short or empty.

    Adds ``node``, ``process``, ``shard_pos`` and ``shard_size``.
    """
    return _shard(df, _ceil_split, nodes, procs, pos, total)


def shard_balanced(df: DataFrame, nodes: int = 1, procs: int = 1, pos: str = "_pos",
                   total: str = "_total") -> DataFrame:
    """floor(n/parts) each, the remainder to the first parts; nodes first, then processes."""
    return _shard(df, _balanced_split, nodes, procs, pos, total)


def pack_batches(df: DataFrame, size: int, single: Column | None = None, alike: Sequence[str] = ()) -> DataFrame:
    """Batch number inside the process, and how many batches the process has.

    A batch holds rows that are equal in the ``alike`` columns, such as the
    model or a shared image: rows are numbered inside (node, process, alike),
    and a process's batches follow one another in that order. Where ``single``
    is true each row is its own batch; with ``alike`` columns it is a property
    of these, without any it is told apart row by row.
    """
    width = F.lit(max(1, size)).cast("bigint")
    if not alike and single is not None:
        flag = "_single"
        flagged = df.withColumn(flag, F.coalesce(single, F.lit(False)))
        return pack_batches(flagged, size, F.col(flag), [flag]).drop(flag)
    if not alike:
        batch = F.floor(F.col("shard_pos") / width).cast("bigint")
        return _labelled(df, batch, F.ceil(F.col("shard_size") / width).cast("bigint"))
    if single is not None:
        width = F.when(F.coalesce(single, F.lit(False)), F.lit(1).cast("bigint")).otherwise(width)
    process = ["node", "process"]
    placed = positions(df.withColumn("_width", width), ["shard_pos"], [*process, *alike], pos="_at", size="_n")
    # One row per process and kind of batch.
    models = placed.groupBy(*process, *alike).agg(F.ceil(F.max("_n") / F.max("_width")).cast("bigint").alias("_own"))
    earlier = Window.partitionBy(*process).orderBy(*alike).rowsBetween(Window.unboundedPreceding, -1)
    models = models.select(
        *[F.col(c).alias(f"_m_{c}") for c in (*process, *alike)], F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_first"),
        F.sum("_own").over(Window.partitionBy(*process)).alias("_all"))
    same = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in (*process, *alike)]
    joined = placed.join(models, same)
    batch = (F.col("_first") + F.floor(F.col("_at") / F.col("_width"))).cast("bigint")
    return _labelled(joined, batch, F.col("_all").cast("bigint")).select(*df.columns, "batch", "batches", "batch_label")


def _labelled(df: DataFrame, batch: Column, batches: Column) -> DataFrame:
    label = F.concat(F.lit("batch "), (batch + 1).cast("string"), F.lit("/"), batches.cast("string"))
    return df.select("*", batch.alias("batch"), batches.alias("batches"), label.alias("batch_label"))


def cannot_batch() -> Column:
    """True for models whose capability record rules out batches of different images."""
    return F.col("batch_disabled") | F.col("shared_image_batch")


def pack_shared_image(df: DataFrame, size: int, image: str = "image_key", order: str = "index") -> DataFrame:
    """Batches of at most ``size`` rows that all use the same image."""
    placed = positions(df, [order], [image], pos="image_pos")
    return placed.withColumn("batch", F.floor(F.col("image_pos") / F.lit(max(1, size))).cast("bigint"))


def expand_samples(df: DataFrame, n="n", sub: str = "sub") -> DataFrame:
    """One row per image to make; ``sub`` is null when there is just one, else 0..n-1."""
    count = F.lit(n) if isinstance(n, int) else F.col(n)
    count = F.greatest(F.coalesce(count, F.lit(1)), F.lit(1)).cast("int")
    rows = df.withColumn("_count", count).withColumn(sub, F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
    return rows.withColumn(sub, F.when(F.col("_count") > 1, F.col(sub))).drop("_count")


def round_robin(df: DataFrame, workers: int, order: list[str]) -> DataFrame:
    """Request number in arrival order, and the worker it goes to."""
    placed = positions(df, order, pos="seq")
    return placed.withColumn("worker", F.pmod(F.col("seq"), F.lit(workers).cast("bigint")).cast("int"))
