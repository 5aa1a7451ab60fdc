"""Results of micro-batches as parts that can be replaced, merged and thrown away.

A micro-batch writes one part under its own number, so a replay replaces it. Now
and then all earlier parts, which are final by then, are merged into one; readers
take the last merged part and what came after it, so a crash between merging
and deleting changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..storage import delete, folders

#: Parts after which they are merged.
MERGE_AFTER = 16


def _name(kind: str, batch: int) -> str:
    return f"{kind}={batch:012d}"


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the parts of a kind that were written whole."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def whole(name: str) -> bool:
        mark = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")
        return mark.getFileSystem(conf).exists(mark)

    return [int(n.split("=")[1]) for n in folders(spark, path) if n.startswith(f"{kind}=") and whole(n)]


def current(spark: SparkSession, path: str, before: int | None = None) -> list[str]:
    """Folders that hold the answer: the last merged part and all parts after it (up to ``before``, not included)."""
    keep = lambda numbers: [n for n in numbers if before is None or n < before]
    merged = keep(_numbers(spark, path, "upto"))
    last = max(merged, default=-1)
    parts = [n for n in keep(_numbers(spark, path, "part")) if n > last]
    return [f"{path}/{_name('upto', last)}"] * bool(merged) + [f"{path}/{_name('part', n)}" for n in parts]


def write_part(part: DataFrame, path: str, batch: int, merge: Callable[[DataFrame], DataFrame], merge_after: int = MERGE_AFTER) -> None:
    """Write a micro-batch's part; merge the earlier ones when there are many."""
    spark = part.sparkSession
    part.write.mode("overwrite").parquet(f"{path}/{_name('part', batch)}")
    old = current(spark, path, batch)
    if len(old) <= merge_after:
        return
    merge(spark.read.schema(part.schema).parquet(*old)).write.mode("overwrite").parquet(f"{path}/{_name('upto', batch - 1)}")
    for folder in folders(spark, path):
        kind, number = folder.split("=")
        if int(number) < batch - (kind == "upto"):
            delete(spark, f"{path}/{folder}")


def read_parts(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The merged answer of all parts so far."""
    return merge(spark.read.parquet(*current(spark, path)))
