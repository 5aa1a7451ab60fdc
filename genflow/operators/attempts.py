"""Attempt-log analytics: health, pacing, rotation, retries, rate audits.

A log has one row per API attempt: ``endpoint``, ``ts`` (timestamp),
``event_id`` (breaks ties, so the order is total), ``task``, ``ok``, ``code``.
A few endpoints own the whole log, so none of these group by endpoint alone:
see :mod:`genflow.operators.order`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.attempts import RetryPolicy, effective_weight, hash_draw
from ..functions.logs import error_family
from .order import BLOCK, IN_BLOCK, before, block_positions, carry, in_blocks, positions, running

WINDOW_SECONDS = 60
MICROS = 1_000_000
ORDER = ["ts", "event_id"]


def assign_endpoints(tasks: DataFrame, endpoints: DataFrame, key: str = "index") -> DataFrame:
    """Weighted endpoint per task, drawn from a hash of the task key.

    The same plan comes out of every run. Each endpoint (``endpoint``,
    ``weight``) owns a range of draws; draws and ranges meet in slots of the
    mean range's length, so a slot holds few ranges however many endpoints
    there are.
    """
    size = endpoints.agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n")).first()
    total = int(size["total"] or 0)
    if total < 1:
        raise ValueError("no endpoints configured")
    slot = max(1, total // size["n"])
    # One row per endpoint: a configuration table, whatever the number of tasks.
    upper = F.sum("weight").over(Window.orderBy("endpoint").rowsBetween(Window.unboundedPreceding, 0))
    ranges = endpoints.select("endpoint", (upper - F.col("weight")).alias("_low"), upper.alias("_high")).where("_low < _high")
    ranges = ranges.withColumn("_slot", F.explode(F.sequence(F.floor(F.col("_low") / slot), F.floor((F.col("_high") - 1) / slot))))
    drawn = tasks.withColumn("draw", hash_draw(key, total)).withColumn("_slot", F.floor(F.col("draw") / slot))
    hit = (drawn["_slot"] == ranges["_slot"]) & (F.col("draw") >= F.col("_low")) & (F.col("draw") < F.col("_high"))
    return drawn.join(ranges, hit, "left").select(*tasks.columns, "draw", "endpoint")


def rotate_keys(log: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Key number each call uses: the k-th call on an endpoint takes key k mod n_keys."""
    placed = positions(log, ORDER, ["endpoint"], pos="call")
    dim = endpoints.select("endpoint", "n_keys")
    keys = F.when(F.col("n_keys") > 0, F.pmod(F.col("call"), F.col("n_keys").cast("bigint")))
    return placed.join(dim, "endpoint", "left").withColumn("key_id", keys)


def endpoint_health(log: DataFrame, endpoints: DataFrame | None = None, start: DataFrame | None = None) -> DataFrame:
    """Outstanding error count after each attempt, and the weight it leaves.

    Errors add one, successes take one off, never below zero: with S the
    running sum of +-1, the count is S - min(0, running minimum of S).
    ``start(endpoint, errors)`` continues from an earlier run.
    """
    rows = in_blocks(log, ["endpoint", *ORDER], "health")
    return _health(rows, endpoints, start)


def _health(rows: DataFrame, endpoints: DataFrame | None, start: DataFrame | None) -> DataFrame:
    columns = [c for c in rows.columns if c not in (BLOCK, IN_BLOCK)]
    step = F.when(F.col("ok"), F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    frame = running(["endpoint"])
    rows = rows.withColumn("_s", F.sum(step).over(frame))
    rows = rows.withColumn("_m", F.min("_s").over(frame))
    earlier = before(["endpoint"])
    table = rows.groupBy("endpoint", BLOCK).agg(
        F.sum(step).alias("_sum"), F.min("_s").alias("_low"))
    table = table.withColumn("_s0", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    table = table.withColumn("_m0", F.min(F.col("_s0") + F.col("_low")).over(earlier))
    table = table.select(F.col("endpoint").alias("_e"), F.col(BLOCK).alias("_b"), "_s0", "_m0")
    rows = rows.join(table, F.col("endpoint").eqNullSafe(F.col("_e")) & (F.col(BLOCK) == F.col("_b"))).drop("_e", "_b")
    initial = F.lit(0).cast("bigint")
    if start is not None:
        # One row per endpoint ever seen.
        state = start.select("endpoint", F.col("errors").alias("_start"))
        rows = rows.join(state, "endpoint", "left")
        initial = F.coalesce(F.col("_start"), initial)
    total = initial + F.col("_s0") + F.col("_s")
    low = F.least(F.lit(0).cast("bigint"), initial + F.col("_m0"), initial + F.col("_s0") + F.col("_m"))
    out = rows.select(*columns, (total - low).alias("errors"))
    if endpoints is None:
        return out
    dim = endpoints.select("endpoint", "weight")
    joined = out.join(dim, "endpoint", "left")
    return joined.withColumn("effective_weight", effective_weight("weight", "errors"))


def paced_schedule(requests: DataFrame, endpoints: DataFrame, start: DataFrame | None = None,
                   window: int = WINDOW_SECONDS) -> DataFrame:
    """Earliest send time of each request with at most R sends in any ``window`` seconds.

    Requests are served in arrival order. With k = position mod R and j =
    position div R, the send time is j windows after the running maximum of
    (arrival - j windows) over the same k. R = 0 means no limit.
    ``start(endpoint, slot, calls, level)`` continues from an earlier run.
    Adds ``call`` (position on the endpoint), ``send_us`` and ``wait_us``.
    """
    columns = requests.columns
    rows = in_blocks(requests, ["endpoint", *ORDER], "pacing")
    rows = block_positions(rows, ["endpoint"], "call")
    dim = endpoints.select("endpoint", F.col("rate_limit").cast("bigint").alias("_rate"))
    rows = rows.join(dim, "endpoint", "left").withColumn("_rate", F.coalesce(F.col("_rate"), F.lit(0).cast("bigint")))
    if start is not None:
        done = start.groupBy("endpoint").agg(F.max("calls").alias("_calls"))
        rows = rows.join(done, "endpoint", "left").withColumn(
            "call", F.col("call") + F.coalesce(F.col("_calls"), F.lit(0))).drop("_calls")
    limited = F.col("_rate") > 0
    rate = F.greatest(F.col("_rate"), F.lit(1).cast("bigint"))
    step = window * MICROS
    rows = rows.withColumn("_slot", F.when(limited, F.pmod(F.col("call"), rate)))
    rows = rows.withColumn("_turn", F.floor(F.col("call") / rate).cast("bigint"))
    rows = rows.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
    rows = rows.withColumn("_level", F.when(limited, F.col("_t") - F.lit(step).cast("bigint") * F.col("_turn")))
    group = ["endpoint", "_slot"]
    rows = rows.withColumn("_high", F.max("_level").over(running(group)))
    rows = carry(rows, group, {"_top": F.max("_level")}, {"_high0": F.max("_top").over(before(group))})
    high = F.greatest(F.col("_high"), F.col("_high0"))
    if start is not None:
        levels = start.select("endpoint", F.col("slot").alias("_slot"), F.col("level").alias("_level0"))
        rows = rows.join(levels, group, "left")
        high = F.greatest(high, F.col("_level0"))
    send = F.when(limited, high + F.lit(step).cast("bigint") * F.col("_turn")).otherwise(F.col("_t"))
    return rows.select(*columns, "call", F.col("_slot").alias("slot"), F.col("_turn").alias("turn"),
                       send.alias("send_us"), (send - F.col("_t")).alias("wait_us"))


def pacing_state(schedule: DataFrame, window: int = WINDOW_SECONDS) -> DataFrame:
    """What the next run of :func:`paced_schedule` needs: calls made and the level per slot."""
    level = F.col("send_us") - F.lit(window * MICROS).cast("bigint") * F.col("turn")
    return schedule.groupBy("endpoint", "slot").agg(
        (F.max("call") + 1).alias("calls"), F.max(level).alias("level"))


def health_state(health: DataFrame) -> DataFrame:
    last = F.max_by("errors", F.struct(*ORDER))
    return health.groupBy("endpoint").agg(last.alias("errors"))


def rate_audit(log: DataFrame, endpoints: DataFrame, window: int = WINDOW_SECONDS) -> DataFrame:
    """Sends in the trailing ``window`` at each send, free slots, and whether the limit broke.

    The window is half-open: a send exactly ``window`` seconds old has expired.
    Each distinct send time counts +n now and -n when it expires, so the answer
    is a running sum over distinct times; sends at one time collapse first.
    """
    sends = log.select("endpoint", F.unix_micros(F.col("ts").cast("timestamp")).alias("_t"))
    per_time = sends.groupBy("endpoint", "_t").agg(F.count(F.lit(1)).alias("_n"))
    steps = per_time.select("endpoint", F.explode(F.array(
        F.struct(F.col("_t").alias("at"), F.col("_n").alias("d"), F.lit(True).alias("sent")),
        F.struct((F.col("_t") + window * MICROS).alias("at"), (-F.col("_n")).alias("d"), F.lit(False).alias("sent")),
    )).alias("step"))
    net = steps.groupBy("endpoint", F.col("step.at").alias("at")).agg(
        F.sum("step.d").alias("d"), F.max("step.sent").alias("sent"))
    rows = in_blocks(net, ["endpoint", "at"], "audit")
    rows = rows.withColumn("_c", F.sum("d").over(running(["endpoint"])))
    rows = carry(rows, ["endpoint"], {"_sum": F.sum("d")},
                 {"_c0": F.coalesce(F.sum("_sum").over(before(["endpoint"])), F.lit(0))})
    counted = rows.where("sent").select("endpoint", F.col("at").alias("_t"), (F.col("_c0") + F.col("_c")).alias("in_window"))
    dim = endpoints.select("endpoint", F.col("rate_limit").cast("bigint").alias("rate_limit"))
    limit = F.coalesce(F.col("rate_limit"), F.lit(0))
    # Unique on the right; a crowded send time on the left is split by AQE.
    return (
        log.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
        .join(counted, ["endpoint", "_t"])
        .join(dim, "endpoint", "left")
        .withColumn("free_slots", F.when(limit > 0, limit - F.col("in_window")))
        .withColumn("violation", (limit > 0) & (F.col("in_window") > limit))
        .drop("_t")
    )


def attempt_numbers(log: DataFrame) -> DataFrame:
    """Attempt number of each row within its task and the wait since the try before."""
    columns = log.columns
    rows = in_blocks(log, ["task", *ORDER], "attempts")
    rows = rows.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
    rows = block_positions(rows, ["task"], "_i")
    rows = rows.withColumn("_prev", F.lag("_t").over(Window.partitionBy("task", BLOCK).orderBy(IN_BLOCK)))
    rows = carry(rows, ["task"], {"_last": F.max("_t")}, {"_last0": F.max("_last").over(before(["task"]))})
    return rows.select(
        *columns, (F.col("_i") + 1).alias("attempt"),
        (F.col("_t") - F.coalesce(F.col("_prev"), F.col("_last0"))).alias("wait_us"))


def retry_stats(log: DataFrame) -> DataFrame:
    """Per task: attempts, failures, endpoints tried, and time from first to last try."""
    # Two-step distinct: (task, endpoint) collapses before the shuffle.
    pairs = log.groupBy("task", "endpoint").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad"),
        F.min("ts").alias("first"), F.max("ts").alias("last"))
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("first", "last")}
    return pairs.groupBy("task").agg(
        F.sum("n").alias("attempts"), F.sum("bad").alias("failures"),
        F.count("endpoint").alias("endpoints_tried"),
        (F.max(micros["last"]) - F.min(micros["first"])).alias("elapsed_us"))


def resolve_attempts(log: DataFrame, policy: RetryPolicy) -> DataFrame:
    """Outcome of each task: its first success, else the last error, within the allowed attempts."""
    tried = attempt_numbers(log).where(F.col("attempt") <= policy.attempts)
    ok = F.col("ok")
    first_ok = F.min_by("event_id", F.when(ok, F.col("attempt")))
    won = F.count_if(ok) > 0
    return tried.groupBy("task").agg(
        won.alias("succeeded"),
        F.when(won, first_ok).alias("result_event"),
        F.when(~won, F.max_by("code", "attempt")).alias("error"),
        F.when(won, F.min(F.when(ok, F.col("attempt")))).otherwise(F.max("attempt")).alias("attempts_used"))


def endpoint_inventory(endpoints: DataFrame) -> DataFrame:
    """One row: endpoints, keys over all of them, and whether there is any key."""
    return endpoints.agg(
        F.count(F.lit(1)).alias("endpoints"),
        F.coalesce(F.sum("n_keys"), F.lit(0)).cast("bigint").alias("total_keys"),
        F.coalesce(F.bool_or(F.col("n_keys") > 0), F.lit(False)).alias("has_keys"))


def error_report(rows: DataFrame, code: str = "code") -> DataFrame:
    """Counts by family and code with family and overall totals ('ALL')."""
    coded = rows.where(F.col(code).isNotNull()).select(
        F.coalesce(error_family(code), F.lit("unknown")).alias("family"), F.col(code).alias("code"))
    counts = coded.rollup("family", "code").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("family").alias("_f"), F.grouping("code").alias("_c"))
    return counts.select(
        F.when(F.col("_f") == 1, F.lit("ALL")).otherwise(F.col("family")).alias("family"),
        F.when(F.col("_c") == 1, F.lit("ALL")).otherwise(F.col("code")).alias("code"), "n")
