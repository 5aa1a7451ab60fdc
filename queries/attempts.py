"""Attempt-log analytics over the whole event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from genflow.functions.attempts import RetryPolicy, hash_draw
from genflow.operators.attempts import (
    assign_endpoints, attempt_numbers, endpoint_health, endpoint_inventory, error_report, paced_schedule, rate_audit,
    resolve_attempts, retry_stats, rotate_keys,
)
from genflow.operators.reports import run_summary, throughput
from genflow.operators.shards import round_robin
from genflow.functions.logs import parse_log_line

from .catalog import Tables, query, sql


def log(t: Tables):
    return t.log().select("event_id", "ts", "task", "endpoint", "ok", "code")


# The same log with half of all attempts on one endpoint.
HOT = "case when event_id % 8 < 5 then 3 else endpoint end"
HOT_LOG = f"select * exclude (endpoint), {HOT} as endpoint from fast_log"


def hot_log(t: Tables):
    return t.fast_log().withColumn("endpoint", F.expr(HOT)).select("event_id", "ts", "task", "endpoint", "ok", "code")


@query("e7_assign_endpoints", sql("tasks", """select index, draw, case when draw < 1 then 0 when draw < 3 then 1 when draw < 8 then 2 else 3 end as endpoint
    from (select index, cast(('0x' || substr(md5(cast(index as varchar)), 1, 8)) as bigint) % 16 as draw from tasks)"""))
def _(t):
    return assign_endpoints(t.tasks().select("index"), t.endpoints())


@query("e7_hash_draw", "select l_orderkey, l_linenumber, cast(('0x' || substr(md5(cast(l_orderkey as varchar)), 1, 8)) as bigint) % 97 as draw from lineitem")
def _(t):
    return t.read("lineitem").select("l_orderkey", "l_linenumber", hash_draw("l_orderkey", 97).alias("draw"))


@query("f3_run_summary", sql("log", "select count(*) filter (where ok) as successful, count(*) filter (where not ok) as failed, case when bool_and(ok) then 0 else 1 end as exit_code from log"))
def _(t):
    return run_summary(log(t), F.col("ok"))


@query("f4_resolve_attempts", sql("log", """select task, bool_or(ok) as succeeded, arg_min(event_id, n) filter (where ok) as result_event,
    case when not bool_or(ok) then arg_max(code, n) end as error,
    case when bool_or(ok) then min(n) filter (where ok) else max(n) end as attempts_used
    from (select *, row_number() over (partition by task order by ts, event_id) as n from log) where n <= 3 group by task"""))
def _(t):
    return resolve_attempts(log(t), RetryPolicy(retries=2))


@query("f5_error_report", sql("log", """select coalesce(family, 'ALL') as family, coalesce(code, 'ALL') as code, count(*) as n from (
    select code, case when code like 'E2%' then 'api' else 'backend' end as family from log where code is not null) group by rollup (family, code)"""))
def _(t):
    return error_report(log(t))


@query("f6_throughput", sql("log", """select case when grouping(endpoint) = 1 then 'ALL' else cast(endpoint as varchar) end as worker, count(*) as images,
    epoch_us(max(ts)) - epoch_us(min(ts)) as elapsed_us, count(*) * 1e6::double / (epoch_us(max(ts)) - epoch_us(min(ts)))::double as images_per_second
    from log group by rollup (endpoint)"""))
def _(t):
    return throughput(log(t), worker="endpoint")


@query("f6_throughput_from_lines", sql("log", """select case when grouping(event_id % 4) = 1 then 'ALL' else cast(event_id % 4 as varchar) end as worker,
    count(*) as images, 0 as elapsed_us, cast(null as double) as images_per_second from log group by rollup (event_id % 4)"""))
def _(t):
    lines = t.log().select(parse_log_line("line").alias("p")).select("p.*").where("kind = 'saved'")
    return throughput(lines, worker="process")


@query("f8_endpoint_inventory", """select count(*) as endpoints, cast(sum(p_size % 4) as bigint) as total_keys, bool_or(p_size % 4 > 0) as has_keys from part""")
def _(t):
    return endpoint_inventory(t.read("part").selectExpr("p_partkey as endpoint", "p_size % 4 as n_keys"))


@query("g6_rotate_keys", sql("fast_log endpoints", f"""select event_id, call, call % n_keys as key_id from (
    select event_id, endpoint, row_number() over (partition by endpoint order by t, event_id) - 1 as call from ({HOT_LOG}))
    join endpoints using (endpoint)"""))
def _(t):
    return rotate_keys(hot_log(t), t.endpoints()).select("event_id", "call", "key_id")


@query("g7_round_robin", sql("log", """select event_id, seq, cast(seq % 7 as integer) as worker from (
    select event_id, row_number() over (order by ts, event_id) - 1 as seq from log)"""))
def _(t):
    return round_robin(log(t), 7, ["ts", "event_id"]).select("event_id", "seq", "worker")


@query("g8_endpoint_health", sql("fast_log endpoints", f"""select event_id, errors, case when errors = 0 then cast(weight as bigint) else greatest(1, weight // cast(pow(2, least(errors, 4)) as bigint)) end as effective_weight
    from (select event_id, endpoint, cast(s - least(0, min(s) over (partition by endpoint order by t, event_id rows unbounded preceding)) as bigint) as errors from (
      select *, sum(case when ok and event_id % 2 = 0 then -1 else 1 end) over (partition by endpoint order by t, event_id rows unbounded preceding) as s from ({HOT_LOG})))
    join endpoints using (endpoint)"""))
def _(t):
    # About six failures in ten, so that error counts rise and fall.
    rows = hot_log(t).withColumn("ok", F.expr("ok and event_id % 2 = 0"))
    return endpoint_health(rows, t.endpoints()).select("event_id", "errors", "effective_weight")


@query("g9_paced_schedule", sql("fast_log endpoints", f"""select event_id, case when rate_limit = 0 then t else 60000000 * j +
      max(t - 60000000 * j) over (partition by endpoint, k order by t, event_id rows unbounded preceding) end as send_us from (
    select *, p // greatest(rate_limit, 1) as j, p % greatest(rate_limit, 1) as k from (
      select *, row_number() over (partition by endpoint order by t, event_id) - 1 as p from ({HOT_LOG}) join endpoints using (endpoint)))"""))
def _(t):
    return paced_schedule(hot_log(t), t.endpoints()).select("event_id", "send_us")


@query("g11_rate_audit", sql("fast_log endpoints", f"""select event_id, n as in_window, case when rate_limit > 0 then rate_limit - n end as free_slots,
    rate_limit > 0 and n > rate_limit as violation from (
    select event_id, endpoint, count(*) over (partition by endpoint order by t range between 59999999 preceding and current row) as n from ({HOT_LOG}))
    join endpoints using (endpoint)"""))
def _(t):
    return rate_audit(hot_log(t), t.endpoints()).select("event_id", "in_window", "free_slots", "violation")


@query("g12_attempt_numbers", sql("log", """select event_id, task, row_number() over (partition by task order by ts, event_id) as attempt,
    epoch_us(ts) - lag(epoch_us(ts)) over (partition by task order by ts, event_id) as wait_us from log"""))
def _(t):
    return attempt_numbers(log(t)).select("event_id", "task", "attempt", "wait_us")


@query("g12_retry_stats", sql("log", """select task, count(*) as attempts, count(*) filter (where not ok) as failures,
    count(distinct endpoint) as endpoints_tried, epoch_us(max(ts)) - epoch_us(min(ts)) as elapsed_us from log group by task"""))
def _(t):
    return retry_stats(log(t))
