"""Positions and running values over very long orders, without one-task windows.

A window with no partition columns, or partitioned by an endpoint that owns a
third of the log, would put all those rows into one task. Here every order is
first cut into blocks of similar size, each a sorted file. A row's place in its
file is its place in the block, so positions need no window; running values use
a window inside each block. A small table of per-block totals carries the state
from block to block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import stored

BLOCK = "_block"
IN_BLOCK = "_in_block"
FILE_BLOCK_ROWS = 65_536


def in_blocks(df: DataFrame, order: Sequence[str], label: str = "ordered") -> DataFrame:
    """``df`` cut into ``_block`` ranges that follow ``order``, whatever the skew.

    Range partitioning splits hot keys too, as long as ``order`` is total.
    ``_in_block`` is the row's 0-based place in its block. The result is stored
    once: block totals and rows are read from the same files, so both see the
    same cuts even if an executor is lost in between.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(ranged.withColumn(BLOCK, F.spark_partition_id()), label)
    return rows.select("*", F.col("_metadata.row_index").alias(IN_BLOCK))


def running(group: Sequence[str]) -> Window:
    """ROWS frame from the start of a (group, block) to the current row."""
    return Window.partitionBy(*group, BLOCK).orderBy(IN_BLOCK).rowsBetween(Window.unboundedPreceding, 0)


def before(group: Sequence[str]) -> Window:
    """Frame over the block table: all earlier blocks of the group."""
    return Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def carry(rows: DataFrame, group: Sequence[str], totals: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """Attach per-block state: ``totals`` aggregates each block, ``carried`` reads earlier blocks.

    The block table holds one row per (group, block), so its window and the
    join, on the balanced (group, block) key, stay small.
    """
    keys = [*group, BLOCK]
    table = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    # A group has one row per range it reaches into, however many rows it owns.
    table = table.select(*keys, *[c.alias(n) for n, c in carried.items()])
    return _join_null_safe(rows, table, keys)


def _join_null_safe(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    right = table.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in table.columns if c not in keys])
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = rows.join(right, condition, "inner")
    return joined.drop(*[f"_r_{k}" for k in keys])


def positions(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), pos: str = "_pos",
              size: str | None = None) -> DataFrame:
    """0-based position of each row in ``order``, inside its ``group`` if one is given.

    ``size`` names a column for the number of rows in the group. ``order`` must
    be total for the result to be repeatable.
    """
    rows = in_blocks(df, [*group, *order], "positions")
    return block_positions(rows, group, pos, size).drop(BLOCK, IN_BLOCK)


def block_positions(rows: DataFrame, group: Sequence[str] = (), pos: str = "_pos", size: str | None = None) -> DataFrame:
    """:func:`positions` for rows from :func:`in_blocks`, which keep their block columns."""
    if group:
        whole = Window.partitionBy(*group)
        earlier = before(group)
    else:
        # One row per block: this table never grows with the data.
        whole = Window.partitionBy()
        earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # A group starts somewhere in its first block and at the top of its later ones.
    carried = {"_offset": F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low")}
    if size:
        carried[size] = F.sum("_n").over(whole)
    rows = carry(rows, group, {"_n": F.count(F.lit(1)), "_low": F.min(IN_BLOCK)}, carried)
    return rows.withColumn(pos, (F.col("_offset") + F.col(IN_BLOCK)).cast("bigint")).drop("_offset")


def source_positions(df: DataFrame, file: str = "_file", row: str = "_row", pos: str = "_pos",
                     size: str = "_total", width: int = FILE_BLOCK_ROWS) -> DataFrame:
    """0-based position among the rows of ``df`` in file name, then row order.

    Works after any filter and reads the order from the files' own row numbers:
    a block is ``width`` consecutive rows of a file, so no block can grow and
    no row leaves for a global sort. Adds ``size``, the number of rows.
    """
    block = F.floor(F.col(row) / F.lit(width)).cast("bigint")
    # Said here once, so that both uses of the counts share one shuffle.
    rows = df.where(F.col(file).isNotNull() & F.col(row).isNotNull()).withColumn(BLOCK, block)
    counts = rows.groupBy(file, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    in_file = Window.partitionBy(file).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_in_file", F.coalesce(F.sum("_n").over(in_file), F.lit(0)))
    # One row per file, like the listing the driver already keeps.
    files = counts.groupBy(file).agg(F.sum("_n").alias("_file_n"))
    by_name = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        F.col(file), F.coalesce(F.sum("_file_n").over(by_name), F.lit(0)).alias("_before"),
        F.sum("_file_n").over(Window.partitionBy()).alias(size))
    offsets = counts.join(files, file).select(
        file, BLOCK, (F.col("_before") + F.col("_in_file")).alias("_offset"), size)
    in_block = F.row_number().over(Window.partitionBy(file, BLOCK).orderBy(row)) - 1
    rows = rows.withColumn(IN_BLOCK, in_block)
    return (
        rows.join(offsets, [file, BLOCK])
        .withColumn(pos, (F.col("_offset") + F.col(IN_BLOCK)).cast("bigint"))
        .drop("_offset", IN_BLOCK, BLOCK)
    )


def dedupe_index(df: DataFrame, keep: str = "first", index: str = "index", pos: str = "_pos") -> DataFrame:
    """One row per index: the first or the last by source position.

    An aggregate, not a window, so copies of one index collapse before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    pick = F.min_by if keep == "first" else F.max_by
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(index).alias("_key")).agg(pick(row, F.col(pos)).alias("_row_kept")).select("_row_kept.*")
