"""What is done, what is left, and full rows for what is left."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .order import dedupe_index


def pending(tasks: DataFrame, outputs: DataFrame, path: str = "expected", resume: bool = True) -> DataFrame:
    """Tasks whose expected path is not among ``outputs(path)``; all tasks when not resuming."""
    if not resume:
        return tasks
    return tasks.join(_paths(outputs, path), path, "left_anti").select(tasks.columns)


def completed(tasks: DataFrame, outputs: DataFrame, path: str = "expected") -> DataFrame:
    return tasks.join(_paths(outputs, path), path, "left_semi").select(tasks.columns)


def with_done(tasks: DataFrame, outputs: DataFrame, path: str = "expected", done: str = "_done") -> DataFrame:
    """All tasks with a flag, so one pass can count both halves."""
    marks = _paths(outputs, path).distinct().withColumn(done, F.lit(True))
    joined = tasks.join(marks, path, "left")
    return joined.select(*tasks.columns, F.coalesce(F.col(done), F.lit(False)).alias(done))


def _paths(outputs: DataFrame, path: str) -> DataFrame:
    return outputs.select(F.col("path").alias(path))


def dataset_stats(tasks: DataFrame, outputs: DataFrame, path: str = "expected", source: str = "") -> DataFrame:
    """One row: total rows, distinct completed indices, pending rows, source."""
    return with_done(tasks, outputs, path).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.when(F.col("_done"), F.col("index"))).alias("completed"),
        F.count_if(~F.col("_done")).alias("pending"),
    ).withColumn("source", F.lit(source))


def load_rows(tasks: DataFrame, wanted: DataFrame, index: str = "index") -> DataFrame:
    """Full rows of the wanted indices; every copy of an index comes back, in no set order."""
    return tasks.join(wanted.select(index), index, "left_semi").select(tasks.columns)


def lookup_index(tasks: DataFrame, value: int, index: str = "index", pos: str = "_pos") -> DataFrame:
    """First row with this index, in source order; empty when there is none."""
    return tasks.where(F.col(index) == value).orderBy(pos).limit(1)


def attach_rows(wanted: DataFrame, rows: DataFrame, index: str = "index", pos: str = "_pos") -> DataFrame:
    """Each wanted index with its row (the last copy wins) or a reason why there is none."""
    # Only wanted rows are sorted out and moved.
    last = dedupe_index(load_rows(rows, wanted, index), "last", index, pos).withColumn("_found", F.lit(True))
    extra = [c for c in wanted.columns if c != index]
    columns = [c for c in rows.columns if c not in (index, *extra)]
    joined = wanted.join(last.select(index, "_found", *columns), index, "left")
    reason = F.when(F.col("_found").isNull(), F.concat(
        F.lit("Skipping index "), F.col(index).cast("string"), F.lit(": row not found")))
    return joined.withColumn("_error", reason).drop("_found")


_PART = re.compile(r"\s*(?:(?P<one>[+-]?\d+)|(?P<low>[+-]?\d*)\s*:\s*(?P<high>[+-]?\d*))?\s*")
#: Positions end here.
_TOP = 2**63 - 1
#: Ranges up to which a filter is one comparison each, which readers can use to skip data.
FEW_RANGES = 16


def row_ranges(expression: str) -> list[tuple[int, int]]:
    """Half-open ranges of an expression such as ``0:100,5,200:``, sorted, without overlaps and gaps of none."""
    found = []
    for part in expression.split(","):
        match = _PART.fullmatch(part)
        if match is None:
            raise ValueError(f"no row or range of rows: {part.strip()!r}")
        if match["one"] is not None:
            found.append((int(match["one"]), int(match["one"]) + 1))
        elif match["low"] is not None:
            found.append((int(match["low"] or 0), int(match["high"] or _TOP)))
    merged: list[tuple[int, int]] = []
    for low, high in sorted(f for f in found if f[0] < f[1]):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def filter_rows(df: DataFrame, expression: str, pos: str = "_pos") -> DataFrame:
    """Rows at the positions of an expression such as ``0:100,5,200:`` (half-open ranges).

    However many ranges there are, a row takes one binary search over their
    sorted bounds: it is inside one if an odd number of bounds is at or below it.
    """
    ranges = row_ranges(expression)
    if not ranges:
        return df.where(F.lit(False))
    at = F.col(pos)
    hull = (at >= ranges[0][0]) & (at < ranges[-1][1])
    if len(ranges) <= FEW_RANGES:
        inside = [(at >= low) & (at < high) for low, high in ranges]
        return df.where(hull & reduce(lambda a, b: a | b, inside))
    bounds = [x for r in ranges for x in r]
    # The bounds are one literal: a chain of thousands of comparisons would not plan.
    listed = F.from_json(F.lit(f"[{','.join(map(str, bounds))}]"), "array<bigint>")
    steps = F.lit([1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)])

    def step(below, width):
        return F.when(F.get(listed, below + width - 1) <= at, below + width).otherwise(below)

    return df.where(hull & (F.aggregate(steps, F.lit(0), step) % 2 == 1))


def output_collisions(tasks: DataFrame, path: str = "expected", index: str = "index") -> DataFrame:
    """Paths that more than one task would write, with how many and the smallest index."""
    return (
        tasks.groupBy(path)
        .agg(F.count(F.lit(1)).alias("claims"), F.min(index).alias("first_index"))
        .where(F.col("claims") > 1)
    )


def reconcile_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every key once, as 'matched', 'missing' (left only) or 'unexpected' (right only).

    A union and one aggregate: copies collapse before the shuffle, and no join
    is needed.
    """
    def side(df, is_left):
        return df.select(F.col(key).alias("key"), F.lit(is_left).alias("_l"), F.lit(not is_left).alias("_r"))

    both = side(left, True).unionAll(side(right, False)).where(F.col("key").isNotNull())
    seen = both.groupBy("key").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    status = F.when(F.col("_l") & F.col("_r"), F.lit("matched")).when(F.col("_l"), F.lit("missing")).otherwise(
        F.lit("unexpected"))
    return seen.select("key", status.alias("status"))
