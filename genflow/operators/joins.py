"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..storage import stored

#: Left rows of a key, and bytes that they would carry from the right, from which the key is salted.
HOT_ROWS, HOT_BYTES = 1_000_000, 1 << 30
#: Hot keys, those with most rows first, whose salts are sent to all tasks; a later one owns less than this part of the rows.
SENT_KEYS = 1_000


def salted_left_join(left: DataFrame, right: DataFrame, key: str, salt_by: Sequence[str], hot_rows: int = HOT_ROWS,
                     data: str | None = None, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Left join on ``key`` with hot keys of the left side spread over several tasks.

    Every key with more than ``hot_rows`` rows gets ``rows / hot_rows`` salts,
    and only its right rows are copied, once per salt. With ``data``, a binary
    column of the right side, a key whose rows would carry more than
    ``hot_bytes`` of it is hot as well: a large image shared by few rows.
    ``salt_by`` names columns that tell left rows apart.

    No left row moves by a key that owns a large share of the rows: the salts of
    the ``SENT_KEYS`` hottest keys are sent to all tasks, and those of other hot
    keys, if there are any, are looked up by a shuffle on key and salt. Null
    keys, which match nothing, are spread too.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col(key).isNotNull())
    salts = F.ceil(F.col("_rows") / F.lit(hot_rows))
    if data is not None:
        sizes = right.groupBy(key).agg(F.sum(F.coalesce(F.octet_length(data), F.lit(0))).alias("_bytes"))
        counts = counts.where("_rows > 1").join(sizes, key, "left")
        carried = F.col("_rows") * F.coalesce(F.col("_bytes"), F.lit(0))
        # No more salts than rows.
        salts = F.least(F.greatest(salts, F.ceil(carried / F.lit(hot_bytes))), F.col("_rows"))
    hot = stored(counts.select(key, "_rows", salts.cast("int").alias("_salts"), F.lit(0).alias("_salt")).where("_salts > 1"), "hot-keys")
    sent = hot.orderBy(F.desc("_rows"), key).limit(SENT_KEYS).select(key, "_salts")
    drawn = F.xxhash64(*salt_by)
    salted = left.join(F.broadcast(sent), key, "left").withColumn("_salt", F.when(F.col(key).isNull(), F.hash(*salt_by)).otherwise(
        F.coalesce(F.pmod(drawn, F.col("_salts")), F.lit(0)).cast("int"))).drop("_salts")
    if hot.count() > SENT_KEYS:
        # A row salted above meets its key here with salt 0 only, which it would get again. That 0 was stored:
        # a literal would leave the key as the only one to shuffle by.
        salted = salted.join(hot.select(key, "_salt", "_salts"), [key, "_salt"], "left").withColumn(
            "_salt", F.coalesce(F.pmod(drawn, F.col("_salts")), F.col("_salt")).cast("int")).drop("_salts")
    copies = right.join(hot.select(key, "_salts"), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
    return salted.join(copies.drop("_salts"), [key, "_salt"], "left").drop("_salt")
