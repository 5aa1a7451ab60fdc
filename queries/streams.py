"""Streams over the given tables, drained and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from genflow.storage import new_path
from genflow.streaming.attempts import (
    read_errors, read_log_stream, read_rate, stream_errors, stream_health, stream_pacing, stream_rate, with_event_time,
)
from genflow.streaming.requests import stream_requests
from genflow.streaming.resume import read_stream_manifest, stream_resume

from .attempts import HOT, HOT_LOG
from .catalog import FAST_US, LOG, REQUESTS, TASKS, query, sql


def _stream(t, table: str):
    # Written as a pattern, because a stream source takes no single file by name.
    return read_log_stream(t.spark, t.path(table).removesuffix("t") + "[t]", t.read(table).schema)


def _in_files(t, df, files: int = 6):
    """The rows of ``df`` from several files, one micro-batch each."""
    path = new_path(t.spark, "arriving")
    df.repartitionByRange(files, "event_id" if "event_id" in df.columns else "index").write.parquet(path)
    return read_log_stream(t.spark, path, df.schema, 1)


def _log(t):
    return with_event_time(_stream(t, "events").selectExpr(*LOG))


def _fast_log(t):
    fast = F.expr(FAST_US.format(us="unix_micros(ts)", div="div"))
    return _log(t).withColumn("ts", F.timestamp_micros(fast)).withColumn("endpoint", F.expr(HOT)).select(
        "event_id", "ts", "task", "endpoint", "ok", "code")


@query("l1_stream_requests", sql("requests", """select request_id, cast(sub as integer) as sub, cast(200 as integer) as status from (
      select request_id, case when turn % 5 = 0 then unnest(range(0, 3)) end as sub from requests where turn % 5 = 0
      union all select request_id, null from requests where turn % 5 in (1, 2, 3))
    union all select request_id, null, 400 from requests where turn % 5 = 4"""))
def _(t):
    accepted, rejected = new_path(t.spark, "accepted"), new_path(t.spark, "rejected")
    stream = _stream(t, "conversations").selectExpr(*REQUESTS)
    stream_requests(stream, accepted, rejected, new_path(t.spark, "ck")).awaitTermination()
    good = t.spark.read.parquet(accepted).select("request_id", "sub", F.col("_status").alias("status"))
    bad = t.spark.read.parquet(rejected).select("request_id", F.lit(None).cast("int").alias("sub"), F.col("_status").alias("status"))
    return good.unionByName(bad)


@query("l2_stream_rate", sql("log", """select endpoint, start_us, count(*) as sends from (
    select endpoint, (epoch_us(ts) // 10000000) * 10000000 - unnest(range(0, 6)) * 10000000 as start_us from log) group by all"""))
def _(t):
    path = new_path(t.spark, "rate")
    rows = with_event_time(t.read("events").selectExpr(*LOG))
    stream_rate(_in_files(t, rows), path, new_path(t.spark, "ck"), merge_after=2).awaitTermination()
    return read_rate(t.spark, path).select("endpoint", F.unix_micros("start").alias("start_us"), "sends")


@query("l3_stream_health", sql("fast_log", f"""select event_id, cast(s - least(0, min(s) over (partition by endpoint order by t, event_id rows unbounded preceding)) as bigint) as errors from (
    select *, sum(case when ok and event_id % 2 = 0 then -1 else 1 end) over (partition by endpoint order by t, event_id rows unbounded preceding) as s from ({HOT_LOG}))"""))
def _(t):
    out = new_path(t.spark, "health")
    stream = _fast_log(t).withColumn("ok", F.expr("ok and event_id % 2 = 0"))
    stream_health(stream, out, new_path(t.spark, "state"), new_path(t.spark, "ck")).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "errors")


@query("l4_stream_pacing", sql("fast_log endpoints", f"""select event_id, case when rate_limit = 0 then t else 60000000 * j +
      max(t - 60000000 * j) over (partition by endpoint, k order by t, event_id rows unbounded preceding) end as send_us from (
    select *, p // greatest(rate_limit, 1) as j, p % greatest(rate_limit, 1) as k from (
      select *, row_number() over (partition by endpoint order by t, event_id) - 1 as p from ({HOT_LOG}) join endpoints using (endpoint)))"""))
def _(t):
    out = new_path(t.spark, "pacing")
    stream_pacing(_fast_log(t), t.endpoints(), out, new_path(t.spark, "state"), new_path(t.spark, "ck")).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "send_us")


@query("l5_stream_resume", sql("tasks", """select printf('%06d', index // 2) || '.png' as path, min(index) // 2 as index from tasks group by 1"""))
def _(t):
    # Two tasks share each index, in the same or in different micro-batches.
    manifest = new_path(t.spark, "manifest")
    rows = t.read("documents").selectExpr(*TASKS).select("index")
    stream = _in_files(t, rows, 3).withColumn("index", F.expr("index div 2"))
    stream_resume(stream, lambda pending: pending, manifest, new_path(t.spark, "ck"), buckets=8, merge_after=1).awaitTermination()
    return read_stream_manifest(t.spark, manifest).select("path", "index")


@query("l6_stream_errors", sql("log", """select (epoch_us(ts) // 60000000) * 60000000 as start_us, code, case when code like 'E2%' then 'api' else 'backend' end as family, count(*) as errors
    from log where code is not null group by all"""))
def _(t):
    path = new_path(t.spark, "errors")
    rows = with_event_time(t.read("events").selectExpr(*LOG))
    stream_errors(_in_files(t, rows), path, new_path(t.spark, "ck"), merge_after=2).awaitTermination()
    return read_errors(t.spark, path).select(F.unix_micros("start").alias("start_us"), "code", "family", "errors")
