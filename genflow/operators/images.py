"""Image reference tables: explode, fetch once, join to bytes, regroup."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.images import image_cache_key, is_remote
from ..sources.outputs import location
from ..storage import folders, stored
from .joins import HOT_BYTES, HOT_ROWS, salted_left_join

FETCH_TIMEOUT = 30
#: Bytes of images that one loading task holds before it hands them on.
LOADED_BYTES = 16 << 20
#: Folders that each run's part of the fetch cache is split into.
CACHE_BUCKETS = 256
BLOB_SCHEMA = "key string, data binary, error string"


def explode_images(df: DataFrame, col: str = "images", key: Sequence[str] = ("index",)) -> DataFrame:
    """One row per reference: ``ref_pos`` and ``ref``; tasks without images give none."""
    return df.select(*key, F.posexplode(col).alias("ref_pos", "ref"))


def with_ref_key(refs: DataFrame, ref: str = "ref", key: str = "key") -> DataFrame:
    """Cache key of a remote reference, the path itself for a local one."""
    return refs.withColumn(key, F.when(is_remote(F.col(ref)), image_cache_key(ref)).otherwise(F.col(ref)))


def distinct_refs(refs: DataFrame, key: str = "key", ref: str = "ref") -> DataFrame:
    """Each key once, with one reference that has it."""
    return refs.groupBy(key).agg(F.min(ref).alias(ref))


def fetch_images(refs: DataFrame, fetcher: Callable[[str, int], bytes], cache_path: str | None = None,
                 timeout: int = FETCH_TIMEOUT) -> DataFrame:
    """Bytes of remote references through the caller's ``fetcher(url, timeout)``.

    Every key is fetched once; keys already in the cache are not fetched again.
    A failed fetch is a row with an error and is tried again next time.

    The cache is a Parquet folder for each run, split into buckets by the key's
    hash. A run looks for its keys by name in the buckets they fall in, writes
    what it fetches once, into its own folder, and opens older bytes only for
    the rows it returns. If two runs at once fetched a key, the one whose folder
    comes first counts.
    """
    wanted = distinct_refs(with_ref_key(refs.where(is_remote(F.col("ref")))))
    if cache_path is None:
        return _fetched(wanted, fetcher, timeout)
    spark = refs.sparkSession
    wanted = stored(wanted.withColumn("bucket", _bucket("key")), "wanted")
    known = None
    if any(name.startswith("run=") for name in folders(spark, cache_path)):
        touched = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]  # CACHE_BUCKETS numbers at most
        cached = spark.read.schema(f"{BLOB_SCHEMA}, run string, bucket int").parquet(cache_path).where(
            F.col("bucket").isin(touched) & F.col("error").isNull())
        held = stored(cached.join(wanted.select("bucket", "key"), ["bucket", "key"], "left_semi")
                      .groupBy("bucket", "key").agg(F.min("run").alias("run")), "held")
        known = cached.join(held, ["run", "bucket", "key"]).select("key", "data", "error")
        wanted = wanted.join(held.select("key"), "key", "left_anti")
    # Written before it is read: a second action must not fetch again.
    run = f"{cache_path.rstrip('/')}/run={uuid.uuid4().hex}"
    _fetched(wanted.select("key", "ref"), fetcher, timeout).withColumn("bucket", _bucket("key")).write.partitionBy("bucket").parquet(run)
    fresh = spark.read.schema(f"{BLOB_SCHEMA}, bucket int").parquet(run).select("key", "data", "error")
    return fresh if known is None else known.unionByName(fresh)


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(CACHE_BUCKETS)).cast("int")


def _by_bytes(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Rows of (key, data, error), handed on whenever they hold ``LOADED_BYTES``."""
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += len(row[1] or b"")
        if held >= LOADED_BYTES:
            yield pd.DataFrame(part, columns=["key", "data", "error"])
            part, held = [], 0
    if part:
        yield pd.DataFrame(part, columns=["key", "data", "error"])


def _fetched(wanted: DataFrame, fetcher, timeout: int) -> DataFrame:
    def one(key, ref):
        try:
            return key, fetcher(ref, timeout), None
        except Exception as error:
            return key, None, f"{type(error).__name__}: {error}"

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _by_bytes(one(key, ref) for key, ref in zip(batch["key"], batch["ref"]))

    return wanted.select("key", "ref").mapInPandas(fetch, BLOB_SCHEMA)


def load_image_bytes(refs: DataFrame, root: str) -> DataFrame:
    """Bytes of local references below ``root``; an unreadable one is an error row.

    Only the wanted files are opened, each by one task, whatever their names.
    """
    where = location(root)

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(where)
        def one(key):
            path, data = posixpath.normpath(str(key).split("://", 1)[-1].removeprefix("file:")), None
            if path.startswith(base.rstrip("/") + "/"):
                try:
                    with fs.open_input_stream(path) as source:
                        data = source.read()
                except OSError:
                    pass
            return key, data, None if data is not None else f"cannot read {key}"

        for batch in batches:
            yield from _by_bytes(map(one, batch["key"]))

    wanted = refs.where(~is_remote(F.col("ref"))).select(F.col("ref").alias("key")).distinct()
    return wanted.mapInPandas(load, BLOB_SCHEMA)


def join_images(refs: DataFrame, blobs: DataFrame, key: str = "key", row: Sequence[str] = ("index", "ref_pos"),
                hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """References with their bytes; a popular image, or a large one that several share, is copied to several tasks, not one."""
    return salted_left_join(refs, blobs, key, row, hot_rows, "data" if "data" in blobs.columns else None, hot_bytes)


def regroup_images(refs: DataFrame, strict: bool = True, key: Sequence[str] = ("index",), value: str = "data") -> DataFrame:
    """One row per task with its images in order.

    ``strict`` (path inputs): one missing image leaves the task without images
    and with an error. Otherwise (embedded inputs) missing ones are dropped.
    A group is one task's own reference list, which came from a single row.
    """
    items = F.sort_array(F.collect_list(F.when(
        F.col(value).isNotNull(), F.struct("ref_pos", F.col(value).alias("v")))))
    grouped = refs.groupBy(*key).agg(
        items.alias("_items"), F.count(F.lit(1)).alias("_refs"), F.count(value).alias("_loaded"))
    images = F.transform("_items", lambda x: x["v"])
    if not strict:
        return grouped.select(*key, images.alias("images"), F.lit(None).cast("string").alias("_error"))
    whole = F.col("_refs") == F.col("_loaded")
    return grouped.select(
        *key, F.when(whole, images).alias("images"),
        F.when(~whole, F.lit("failed to load images")).alias("_error"))


def keep_loaded(col: str = "input_images"):
    """Embedded inputs: the bytes that are there, bad items dropped, order kept."""
    return F.transform(
        F.filter(F.coalesce(F.col(col), F.array()), lambda x: x["bytes"].isNotNull()), lambda x: x["bytes"])
