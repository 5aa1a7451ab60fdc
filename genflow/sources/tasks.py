"""Readers for task tables and prompt files."""

from __future__ import annotations

import warnings
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.naming import drop_blank, with_index
from ..functions.text import strict_json, strip
from ..storage import stored
from .pieces import csv_records, json_items

PROMPT_FIELDS = ("prompt", "negative_prompt", "height", "width")


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name[name.rfind("."):].lower() if "." in name else ""


def _parquet_files(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files directly inside a folder, as the driver lists them anyway; hidden names are refused.

    Spark passes over names that start with ``_`` or ``.`` without a word.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    statuses = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    files = [s.getPath() for s in statuses if s.getPath().getName().lower().endswith(".parquet")]
    hidden = sorted(f.getName() for f in files if f.getName()[0] in "_.")
    if hidden:
        raise ValueError(f"Spark does not read files that start with '_' or '.': {', '.join(hidden[:5])} in {path}; rename them")
    if not files:
        raise FileNotFoundError(f"no *.parquet file in {path}")
    return sorted(f.toString() for f in files)


def _parquet(spark: SparkSession, path: str, index: str) -> DataFrame:
    """All columns of all files, with ``_file`` and ``_row``.

    A column that some files lack is null there. Files whose index has another
    type are read apart and meet the others as text, to be cast row by row;
    any other conflict of types is an error that names the column.
    """
    def placed(*paths):
        df = spark.read.option("mergeSchema", True).parquet(*paths)
        return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))

    if _suffix(path) == ".parquet":
        if path.rstrip("/").rsplit("/", 1)[-1][0] in "_.":
            raise ValueError(f"Spark does not read files that start with '_' or '.': {path}; rename it")
        return placed(path)
    files = _parquet_files(spark, path)
    try:
        return placed(*files)
    except (PySparkException, Py4JJavaError) as error:
        if "MERGE" not in str(error).upper():  # else two types of one column
            raise
    kinds: dict[tuple, list[str]] = {}
    for file in files:
        kinds.setdefault(tuple(spark.read.parquet(file).dtypes), []).append(file)
    types: dict[str, set[str]] = {}
    for kind in kinds:
        for name, of in kind:
            types.setdefault(name, set()).add(of)
    clash = sorted(n for n, of in types.items() if n != index and len(of) > 1)
    if clash:
        raise ValueError(f"columns with different types in the files of {path}: {', '.join(clash)}")
    parts = [placed(*paths) for paths in kinds.values()]
    parts = [p.withColumn(index, F.col(index).cast("string")) if index in p.columns else p for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_tasks_parquet(spark: SparkSession, path: str, index_only: bool = False, name_col: str | None = None,
                       index: str = "index") -> DataFrame:
    """One Parquet file, or every ``*.parquet`` directly inside a folder.

    Adds ``_file``, ``_row`` (row number in the file) and ``_pos`` (0-based
    position in file name, then row order). Rows whose index is not an integer
    are skipped; a table without the column uses the position instead.
    """
    df = _parquet(spark, path, index)
    has_index = index in df.columns
    if index_only:
        df = df.select(*[c for c in (index, name_col) if c and c in df.columns], "_file", "_row")
    df = with_file_positions(df)
    if has_index:
        return with_index(df, index)
    warnings.warn(f"{path} has no column {index!r}; row positions are used instead", stacklevel=2)
    return with_index(df, index, fallback="_pos")


def with_file_positions(df: DataFrame) -> DataFrame:
    """``_pos`` for an unfiltered scan: rows in earlier files plus the row number.

    Counting rows per file reads no data columns, and no row is shuffled.
    """
    files = df.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # One row per file, like the listing the driver already keeps.
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    # Stored, so that the footers are read for it once.
    starts = stored(starts, "files")
    joined = df.join(starts, "_file")
    return joined.select(*df.columns, (F.col("_start") + F.col("_row")).alias("_pos"))


def read_parquet_dir_reindexed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a folder with ``index`` replaced by the position over all files."""
    df = _parquet(spark, path, "index")
    return with_file_positions(df).withColumn("index", F.col("_pos"))


def _numbered(df: DataFrame) -> DataFrame:
    """``_row`` and ``_pos``: 0-based record number inside a text file, blank records included.

    Record ids grow along a file split, so the order inside a split needs no
    sort of the whole file; splits are stitched with their row counts.
    """
    df = df.select("*", F.col("_metadata.file_path").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_split"),
                   F.monotonically_increasing_id().alias("_id"))
    split = Window.partitionBy("_file", "_split")
    rows = df.withColumn("_in_split", F.row_number().over(split.orderBy("_id")) - 1)
    counts = rows.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_file", "_split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    rows = rows.join(starts, ["_file", "_split"])
    rows = rows.withColumn("_row", (F.col("_start") + F.col("_in_split")).cast("bigint"))
    return rows.withColumn("_pos", F.col("_row")).drop("_split", "_id", "_in_split", "_start")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """Named text columns with ``_file``, ``_row`` and ``_pos``, of CSV files that many tasks read; quotes may hold line breaks."""
    records = csv_records(spark, path)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    # The reader itself names the columns from the first record, so blank and repeated names come out as they always did.
    names = spark.read.csv(path, header=True, encoding="UTF-8", **options).columns
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    cells = F.from_csv("value", F.lit(fields.toDDL()), options)
    rows = records.where("record > 0").select(cells.alias("_cells"), "_file", (F.col("record") - 1).alias("_row"))
    return rows.select(*[F.coalesce(F.col(f"_cells.c{i}"), F.lit("")).alias(n) for i, n in enumerate(names)],
                       "_file", F.col("_row").cast("bigint").alias("_row"), F.col("_row").cast("bigint").alias("_pos"))


def read_tasks_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV with a header; all text, ``index`` an integer or the row number when absent.

    An index that is no integer is an error that names file and record. Quoted
    cells may hold line breaks, and a large file is still read in many tasks.
    ``multiline=False`` saves the search for them where there are none.
    """
    if multiline:
        rows = _csv(spark, path)
        named = rows.columns[:-3]
    else:
        df = spark.read.csv(path, header=True, quote='"', escape='"', encoding="UTF-8")
        # Missing cells are empty text.
        df = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns], "_metadata")
        named = df.columns[:-1]
        rows = _numbered(df).drop("_metadata")
    if "index" not in named:
        return with_index(rows, "index", fallback="_pos")
    value = strip("index").try_cast("bigint")
    return rows.withColumn("index", F.coalesce(value, F.raise_error(F.concat(
        F.lit("index is no integer in "), F.col("_file"), F.lit(", record "), F.col("_row").cast("string"))).cast("bigint")))


def read_prompts_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return read_tasks_csv(spark, path, multiline)


def _prompt_columns(value: Column, pos: Column, fields: tuple[str, ...]) -> list[Column]:
    is_text = F.schema_of_variant(value) == "STRING"
    index = F.coalesce(F.try_variant_get(value, "$.index", "bigint"), pos)
    out = [index.alias("index"), F.when(is_text, F.try_variant_get(value, "$", "string")).otherwise(
        F.try_variant_get(value, "$.prompt", "string")).alias("prompt")]
    for name in fields:
        if name != "prompt":
            kind = "int" if name in ("height", "width") else "string"
            out.append(F.try_variant_get(value, f"$.{name}", kind).alias(name))
    return [*out, value.alias("fields")]


def read_prompts_jsonl(spark: SparkSession, path: str, fields: tuple[str, ...] = PROMPT_FIELDS) -> DataFrame:
    """One JSON object or string per line; a missing index is the line number, blank lines counted.

    ``fields`` become columns; the whole object stays in the VARIANT ``fields``.
    A malformed line is an error.
    """
    lines = _numbered(spark.read.text(path).select("value", "_metadata"))
    lines = drop_blank(lines, "value").withColumn("_json", strict_json(strip("value")))
    parsed = F.when(F.col("_json").isNull(), F.raise_error(
        F.concat(F.lit("malformed JSON in prompt line "), F.col("_pos").cast("string"))).cast("variant")).otherwise(F.col("_json"))
    return lines.withColumn("_json", parsed).select(
        *_prompt_columns(F.col("_json"), F.col("_pos"), fields), "_file", "_row", "_pos")


def read_prompts_json(spark: SparkSession, path: str, fields: tuple[str, ...] = PROMPT_FIELDS) -> DataFrame:
    """A JSON array of objects or strings; a missing index is the array position.

    A malformed item is an error. A large file is read in many tasks.
    """
    rows = json_items(spark, path).select(F.col("_file"), F.col("record").cast("bigint").alias("_pos"), strict_json(strip("value")).alias("_json"))
    parsed = F.when(F.col("_json").isNull(), F.raise_error(F.concat(
        F.lit("a JSON prompt file must contain an array; malformed item "), F.col("_pos").cast("string"))).cast("variant")).otherwise(F.col("_json"))
    rows = rows.withColumn("_json", parsed)
    return rows.select(
        *_prompt_columns(F.col("_json"), F.col("_pos"), fields), "_file", F.col("_pos").alias("_row"), "_pos")


def read_prompts_txt(spark: SparkSession, path: str) -> DataFrame:
    """One prompt per non-blank line; ``index`` is the line number."""
    lines = _numbered(spark.read.text(path).select("value", "_metadata"))
    return drop_blank(lines, "value").select(F.col("_pos").alias("index"), strip("value").alias("prompt"), "_file", "_row", "_pos")


def read_tasks(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Editing tasks: a folder or Parquet file, or a CSV file."""
    fmt = (fmt or _suffix(path).lstrip(".") or "parquet").lower()
    readers = {"parquet": read_tasks_parquet, "csv": read_tasks_csv}
    if fmt not in readers:
        raise ValueError(f"unsupported file format: .{fmt}")
    return readers[fmt](spark, path, **options)


def read_prompts(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Prompts from .jsonl, .json, .txt or .csv, by suffix in any case."""
    fmt = (fmt or _suffix(path).lstrip(".")).lower()
    readers = {"jsonl": read_prompts_jsonl, "json": read_prompts_json, "txt": read_prompts_txt, "csv": read_prompts_csv}
    if fmt not in readers:
        raise ValueError(f"unsupported file format: .{fmt}")
    return readers[fmt](spark, path, **options)


def single_prompt(spark: SparkSession, text: str) -> DataFrame:
    return spark.range(1).select(F.lit(0).cast("bigint").alias("index"), F.lit(text).alias("prompt"))


def load_prompts(spark: SparkSession, prompt: str | None = None, path: str | None = None) -> DataFrame:
    """A single prompt wins over a prompt file."""
    if prompt:
        return single_prompt(spark, prompt)
    if path:
        return read_prompts(spark, path)
    raise ValueError("give a prompt or a prompt file")


