"""Records of formats whose separators may stand inside quotes, read in many tasks.

A file is read as pieces between separators, which Spark splits by bytes
anywhere. What a separator means depends on all text before it, but only through
a running sum (of quotes, of brackets): sums inside a split, and over the splits
before it, give every piece its state. Pieces that belong together are joined;
nothing needs the whole file in one task or cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..storage import stored

FILE, SPLIT, AT = "_file", "_split", "_at"


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``value`` between separators, with file, split and an id that grows along a split. A byte order mark is dropped."""
    rows = spark.read.text(path, lineSep=separator).select(
        F.regexp_replace("value", "^﻿", "").alias("value"), F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT), F.monotonically_increasing_id().alias(AT))
    return stored(rows, "pieces")


def with_before(rows: DataFrame, amount: Column, name: str) -> DataFrame:
    """``name``: the sum of ``amount`` over all pieces of the file in front of each piece."""
    amount = amount.cast("bigint")
    inside = Window.partitionBy(FILE, SPLIT).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(FILE, SPLIT).agg(F.sum(amount).alias("_n"))
    # One row per split of a file.
    earlier = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(FILE, SPLIT, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carried"))
    summed = rows.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(carried, [FILE, SPLIT]).withColumn(name, F.col("_inside") + F.col("_carried")).drop("_inside", "_carried")


def joined(rows: DataFrame, starts: str, single: Column, separator: str) -> DataFrame:
    """``(_file, record, value)``: pieces from one that ``starts`` a record up to the next, in order.

    ``record`` counts a file's records. Only records of several pieces are
    shuffled; ``single`` says which pieces are a whole record.
    """
    numbered = with_before(rows, F.col(starts).cast("int"), "record")
    # A piece inside a record comes after its start has been counted.
    numbered = numbered.withColumn("record", F.when(F.col(starts), F.col("record")).otherwise(F.col("record") - 1))
    numbered = numbered.withColumn("_single", single)
    alone = numbered.where("_single").select(FILE, "record", "value")
    together = numbered.where("not _single").groupBy(FILE, "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(SPLIT), F.col(AT), F.col("value")))), lambda p: p["value"]), separator).alias("value"))
    return alone.unionByName(together)


def count_of(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, record, value)``: the records of CSV files, header included, line breaks inside quotes kept; blank lines are no records.

    A line starts a record if an even number of quotes stands before it, as a
    doubled quote counts twice. Line ends may be LF or CRLF.
    """
    lines = pieces(spark, path, "\n").withColumn("_quotes", count_of(F.col("value"), '"'))
    lines = with_before(lines, F.col("_quotes"), "_before")
    starts, closed = F.col("_before") % 2 == 0, F.col("_quotes") % 2 == 0
    blank = starts & closed & (F.regexp_replace("value", "\r$", "") == "")
    lines = stored(lines.where(~blank).withColumn("_starts", F.col("_before") % 2 == 0), "csv-lines")
    records = joined(lines, "_starts", F.col("_starts") & closed, "\n")
    return records.withColumn("value", F.replace(F.regexp_replace("value", "\r$", ""), F.lit("\r\n"), F.lit("\n")))


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, record, value)``: the items of JSON files that hold an array, as text; a file of another shape is an error.

    Files are cut at every comma. Quotes that no backslash stands before tell
    whether a comma is inside a string; brackets outside strings give its
    depth, and at depth one a new item starts. Valid JSON has no backslash
    right before a comma, so no escape goes over a cut.
    """
    cut = pieces(spark, path, ",").withColumn("_plain", F.regexp_replace("value", r"(?s)\\.", ""))
    cut = with_before(cut.withColumn("_quotes", count_of(F.col("_plain"), '"')), F.col("_quotes"), "_before")
    inside, ends_inside = F.col("_before") % 2 == 1, (F.col("_before") + F.col("_quotes")) % 2 == 1
    closed = F.concat(F.when(inside, F.lit('"')).otherwise(F.lit("")), F.col("_plain"), F.when(ends_inside, F.lit('"')).otherwise(F.lit("")))
    bare = F.regexp_replace(closed, '"[^"]*+"', '""')
    up = F.length(bare) - F.length(F.translate(bare, "[{", ""))
    down = F.length(bare) - F.length(F.translate(bare, "]}", ""))
    cut = cut.withColumns({"_up": up, "_down": down}).drop("_plain", "_quotes")
    deep = with_before(cut, F.col("_up") - F.col("_down"), "_depth")
    deep = with_before(deep, F.lit(1), "_number")
    first, starts = F.col("_number") == 0, ((F.col("_depth") == 1) & ~inside) | (F.col("_number") == 0)
    deep = stored(deep.select(FILE, SPLIT, AT, "value", "_depth", starts.alias("_starts"), first.alias("_first"),
                              (F.col("_depth") + F.col("_up") - F.col("_down")).alias("_after")), "json-pieces")
    items = joined(deep, "_starts", F.lit(False), ",")
    last = items.groupBy(FILE).agg(F.max("record").alias("_last"))
    items = items.join(last, FILE)
    wrong = F.raise_error(F.lit("a JSON prompt file must contain an array")).cast("string")
    text = F.trim(F.translate("value", "\r\n\t", "   "))
    opened = F.when(F.col("record") > 0, F.col("value")).when(text.startswith("["), F.regexp_replace("value", r"^\s*\[", "")).otherwise(wrong)
    whole = F.when(F.col("record") < F.col("_last"), opened).when(text.endswith("]"), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(wrong)
    items = items.select(FILE, "record", whole.alias("value"), "_last")
    # '[]' has one blank item, which is none.
    return items.where(~((F.col("_last") == 0) & (F.trim(F.translate("value", "\r\n\t", "   ")) == ""))).drop("_last")
