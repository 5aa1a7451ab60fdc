from bisect import bisect_right
from itertools import accumulate
"""Positions, shards and attempt analytics against plain loops, with hot keys and small blocks."""

import random
import re
from collections import defaultdict, deque

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from genflow.functions.attempts import RetryPolicy
from genflow.operators.attempts import (
    assign_endpoints, attempt_numbers, endpoint_health, health_state, paced_schedule, pacing_state, rate_audit,
    resolve_attempts, rotate_keys,
)
from genflow.operators.joins import salted_left_join
from genflow.operators.order import BLOCK, dedupe_index, in_blocks, positions, source_positions
from genflow.operators.shards import pack_batches, pack_shared_image, shard_balanced, shard_ceil

ENDPOINTS = [(0, 1, 0, 2), (1, 2, 3, 2), (2, 5, 7, 3), (3, 8, 2, 1)]


def log_rows(seed, n=3000, spread=600_000_000):
    """Random attempts: most on endpoint 3 and task 0, many equal times."""
    rng = random.Random(seed)
    times = sorted(rng.randrange(spread) // 1_000_000 * 1_000_000 + rng.choice([0, 0, 5]) for _ in range(n))
    return [(i, 1_700_000_000_000_000 + t, 3 if rng.random() < .6 else rng.randrange(3), 0 if rng.random() < .4 else rng.randrange(50),
             rng.random() < .55) for i, t in enumerate(times)]


@pytest.fixture(scope="module")
def rows():
    return log_rows(1)


def frame(spark, rows, partitions=5):
    df = spark.createDataFrame(rows, "event_id long, t long, endpoint long, task long, ok boolean")
    return df.repartition(partitions).select(
        "event_id", F.timestamp_micros("t").alias("ts"), "endpoint", "task", "ok",
        F.when(~F.col("ok"), F.concat(F.lit("E2"), F.lpad((F.col("event_id") % 4).cast("string"), 3, "0"))).alias("code"))


def dim(spark):
    return spark.createDataFrame(ENDPOINTS, "endpoint long, weight int, rate_limit int, n_keys int")


def test_blocks_split_a_hot_key(spark, many_small_blocks, rows):
    cut = in_blocks(frame(spark, rows), ["endpoint", "ts", "event_id"])
    sizes = [r["count"] for r in cut.where("endpoint = 3").groupBy(BLOCK).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < len(rows) / 2


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_positions_do_not_depend_on_partitions(spark, many_small_blocks, rows, partitions):
    df = frame(spark, rows, partitions)
    got = {r["event_id"]: r["_pos"] for r in positions(df, ["ts", "event_id"]).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    grouped = {r["event_id"]: (r["_pos"], r["size"]) for r in positions(df, ["ts", "event_id"], ["endpoint"], size="size").collect()}
    for e in range(4):
        mine = sorted((r for r in rows if r[2] == e), key=lambda r: (r[1], r[0]))
        assert all(grouped[r[0]] == (i, len(mine)) for i, r in enumerate(mine))


def test_positions_with_null_group(spark, many_small_blocks):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "i long, g string")
    got = {r["i"]: r["_pos"] for r in positions(df, ["i"], ["g"]).collect()}
    assert got == {i: i // 2 for i in range(100)}


def test_source_positions_over_files_and_filters(spark, tmp_path):
    n = 0
    for f, size in enumerate([300, 0, 1, 999]):
        pq.write_table(pa.table({"v": pa.array(range(n, n + size), pa.int64())}), tmp_path / f"f{f}.parquet", row_group_size=100)
        n += size
    df = spark.read.parquet(str(tmp_path)).select("v", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    for keep in ("true", "v % 3 <> 0", "v > 299", "v = 300", "false"):
        kept = df.where(keep)
        want = sorted(r["v"] for r in kept.collect())
        got = source_positions(kept, width=64).collect()
        assert {r["v"]: (r["_pos"], r["_total"]) for r in got} == {v: (i, len(want)) for i, v in enumerate(want)}


def split(n, parts, rule):
    if rule == "ceil":
        size = -(-n // parts)
        return [(min(i * size, n), min((i + 1) * size, n)) for i in range(parts)]
    q, m = divmod(n, parts)
    starts = [i * q + min(i, m) for i in range(parts + 1)]
    return list(zip(starts, starts[1:]))


@pytest.mark.parametrize("n,nodes,procs", [(0, 3, 2), (1, 3, 2), (10, 3, 4), (10, 7, 1), (10, 1, 7), (100, 16, 3), (1000, 3, 4), (5, 4, 2)])
@pytest.mark.parametrize("rule", ["ceil", "balanced"])
def test_shards(spark, n, nodes, procs, rule):
    df = spark.range(n).select(F.col("id").alias("_pos"), F.lit(n).cast("bigint").alias("_total"))
    got = (shard_ceil if rule == "ceil" else shard_balanced)(df, nodes, procs).collect()
    want = {}
    for node, (a, b) in enumerate(split(n, nodes, rule)):
        for proc, (c, d) in enumerate(split(b - a, procs, rule)):
            for k in range(c, d):
                want[a + k] = (node, proc, k - c, d - c)
    assert {r["_pos"]: (r["node"], r["process"], r["shard_pos"], r["shard_size"]) for r in got} == want
    if rule == "balanced" and n:
        sizes = defaultdict(int)
        for node, *_ in want.values():
            sizes[node] += 1
        assert max(sizes.values()) - min(sizes.get(i, 0) for i in range(nodes)) <= 1


def test_batches(spark):
    df = spark.range(10).select(F.col("id").alias("shard_pos"), F.lit(10).cast("bigint").alias("shard_size"),
                                F.lit(0).alias("node"), F.lit(0).alias("process"))
    rows = pack_batches(df, 4).orderBy("shard_pos").collect()
    assert [r["batch"] for r in rows] == [0] * 4 + [1] * 4 + [2] * 2
    assert rows[9]["batch_label"] == "batch 3/3"
    alone = pack_batches(df, 4, F.lit(True)).orderBy("shard_pos").collect()
    assert [r["batch"] for r in alone] == list(range(10)) and {r["batches"] for r in alone} == {10}
    some = pack_batches(df, 4, F.col("shard_pos") % 5 == 0).orderBy("shard_pos").collect()
    assert [r["batch"] for r in some] == [2, 0, 0, 0, 0, 3, 1, 1, 1, 1] and {r["batches"] for r in some} == {4}


def test_batches_hold_one_model_and_at_most_its_width(spark, many_small_blocks):
    df = spark.range(600).selectExpr(
        "id % 2 as node", "id % 3 as process", "id as _at0", "case id % 7 when 0 then 'one' when 1 then null when 2 then 'two' else 'many' end as m")
    df = df.selectExpr("*", "row_number() over (partition by node, process order by _at0) - 1 as shard_pos", "100 as shard_size")
    rows = pack_batches(df, 4, F.col("m") == "one", ["m"]).collect()
    batches = defaultdict(list)
    totals = defaultdict(set)
    for r in rows:
        batches[r["node"], r["process"], r["batch"]].append(r["m"])
        totals[r["node"], r["process"]].add(r["batches"])
    assert len(rows) == 600 and all(len(t) == 1 for t in totals.values())
    for held in batches.values():
        assert len(set(held)) == 1 and len(held) <= (1 if held[0] == "one" else 4)
    for (node, process), total in totals.items():
        mine = sorted(b for n, p, b in batches if (n, p) == (node, process))
        assert mine == list(range(total.pop()))


def test_shared_image_batches_never_mix(spark, many_small_blocks):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"i{i % 5}") for i in range(200)], "index long, image_key string")
    groups = defaultdict(list)
    for r in pack_shared_image(df, 8).collect():
        groups[(r["image_key"], r["batch"])].append(r["index"])
    assert all(len(g) <= 8 for g in groups.values())
    for key in {k for k, _ in groups}:
        sizes = [len(groups[(key, b)]) for b in range(len([1 for k, _ in groups if k == key]))]
        assert all(s == 8 for s in sizes[:-1])


def health_loop(rows, weights):
    errors, out = defaultdict(int), {}
    for i, t, e, task, ok in sorted(rows, key=lambda r: (r[1], r[0])):
        errors[e] = max(0, errors[e] - 1) if ok else errors[e] + 1
        w = weights[e]
        out[i] = (errors[e], w if errors[e] == 0 else max(1, w // 2 ** min(errors[e], 4)))
    return out


def pacing_loop(rows, rates, window=60_000_000):
    sent, out = defaultdict(deque), {}
    for i, t, e, task, ok in sorted(rows, key=lambda r: (r[1], r[0])):
        if rates[e] == 0:
            out[i] = t
            continue
        queue = sent[e]
        at = t if len(queue) < rates[e] else max(t, queue[0] + window)
        queue.append(at)
        if len(queue) > rates[e]:
            queue.popleft()
        out[i] = at
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_health_and_pacing(spark, many_small_blocks, seed):
    rows = log_rows(seed)
    df = frame(spark, rows)
    got = {r["event_id"]: (r["errors"], r["effective_weight"]) for r in endpoint_health(df, dim(spark)).collect()}
    assert got == health_loop(rows, {e: w for e, w, _, _ in ENDPOINTS})
    sent = {r["event_id"]: (r["send_us"], r["wait_us"]) for r in paced_schedule(df, dim(spark)).collect()}
    want = pacing_loop(rows, {e: r for e, _, r, _ in ENDPOINTS})
    assert {i: s for i, (s, _) in sent.items()} == want
    assert all(w == want[i] - t for (i, t, *_), (_, w) in ((r, sent[r[0]]) for r in rows))


def test_state_carries_between_runs(spark, many_small_blocks, rows):
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    cuts = [ordered[:700], ordered[700:701], ordered[701:2500], ordered[2500:]]
    health, pacing, errors, sent = None, None, {}, {}
    for part in cuts:
        out = endpoint_health(frame(spark, part), start=health)
        errors.update({r["event_id"]: r["errors"] for r in out.collect()})
        state = health_state(out)
        if health is not None:
            state = state.unionByName(health.join(state, "endpoint", "left_anti"))
        health = spark.createDataFrame(state.collect(), state.schema)
        timed = paced_schedule(frame(spark, part), dim(spark), start=pacing)
        sent.update({r["event_id"]: r["send_us"] for r in timed.collect()})
        after = {(r["endpoint"], r["slot"]): r for r in (pacing.collect() if pacing is not None else [])}
        fresh = pacing_state(timed)
        after.update({(r["endpoint"], r["slot"]): r for r in fresh.collect()})
        pacing = spark.createDataFrame(list(after.values()), fresh.schema)
    assert errors == {i: e for i, (e, _) in health_loop(rows, defaultdict(lambda: 1)).items()}
    assert sent == pacing_loop(rows, {e: r for e, _, r, _ in ENDPOINTS})


def test_rate_audit(spark, many_small_blocks, rows):
    # Exactly 60 seconds old is out; equal times count each other.
    rows = rows + [(9000, rows[0][1] + 60_000_000, rows[0][2], 1, True)]
    rates = {e: r for e, _, r, _ in ENDPOINTS}
    got = {r["event_id"]: r for r in rate_audit(frame(spark, rows), dim(spark)).collect()}
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r[1])
    for i, t, e, *_ in rows:
        n = sum(t - 60_000_000 < x <= t for x in by[e])
        assert got[i]["in_window"] == n
        assert got[i]["violation"] == (rates[e] > 0 and n > rates[e])
        assert got[i]["free_slots"] == (rates[e] - n if rates[e] else None)


def test_attempts_and_outcomes(spark, many_small_blocks, rows):
    tasks = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        tasks[r[3]].append(r)
    got = {r["event_id"]: (r["attempt"], r["wait_us"]) for r in attempt_numbers(frame(spark, rows)).collect()}
    for tries in tasks.values():
        for k, r in enumerate(tries):
            assert got[r[0]] == (k + 1, r[1] - tries[k - 1][1] if k else None)
    outcome = {r["task"]: r for r in resolve_attempts(frame(spark, rows), RetryPolicy(retries=2)).collect()}
    for task, tries in tasks.items():
        tried = tries[:3]
        good = [r for r in tried if r[4]]
        o = outcome[task]
        assert o["succeeded"] == bool(good)
        assert o["result_event"] == (good[0][0] if good else None)
        assert o["error"] == (None if good else f"E2{tried[-1][0] % 4:03d}")
        assert o["attempts_used"] == (tried.index(good[0]) + 1 if good else len(tried))


def test_key_rotation(spark, many_small_blocks, rows):
    calls, want = defaultdict(int), {}
    keys = {e: k for e, _, _, k in ENDPOINTS}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        want[r[0]] = calls[r[2]] % keys[r[2]]
        calls[r[2]] += 1
    assert {r["event_id"]: r["key_id"] for r in rotate_keys(frame(spark, rows), dim(spark)).collect()} == want


def test_endpoint_draw_follows_weights(spark):
    tasks = spark.range(20_000).withColumnRenamed("id", "index")
    got = {r["endpoint"]: r["count"] for r in assign_endpoints(tasks, dim(spark)).groupBy("endpoint").count().collect()}
    for e, w, *_ in ENDPOINTS:
        assert abs(got[e] / 20_000 - w / 16) < .02
    first = assign_endpoints(tasks.repartition(7), dim(spark)).orderBy("index").collect()
    assert first == assign_endpoints(tasks, dim(spark)).orderBy("index").collect()


def test_dedupe(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 5, "b"), (2, 3, "c"), (1, 2, "d")], "index long, _pos long, v string")
    assert {(r["index"], r["v"]) for r in dedupe_index(rows, "first").collect()} == {(1, "a"), (2, "c")}
    assert {(r["index"], r["v"]) for r in dedupe_index(rows, "last").collect()} == {(1, "b"), (2, "c")}


@pytest.mark.parametrize("hot_rows", [1, 10, 1000])
def test_salted_join_is_a_left_join(spark, hot_rows):
    left = spark.createDataFrame([(i, "hot" if i % 2 else ("warm" if i % 3 else f"k{i}")) for i in range(300)] + [(999, None)], "i long, key string")
    right = spark.createDataFrame([("hot", "H"), ("warm", "W"), ("k0", "0"), ("unused", "U")], "key string, v string")
    got = salted_left_join(left, right, "key", ["i"], hot_rows).select("i", "key", "v")
    want = left.join(right, "key", "left").select("i", "key", "v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_large_image_shared_by_few_rows_is_salted(spark):
    left = spark.createDataFrame([(i, "large" if i < 6 else f"k{i % 3}") for i in range(60)], "i long, key string")
    right = spark.createDataFrame([("large", b"x" * 4000)] + [(f"k{i}", b"y" * 10) for i in range(3)], "key string, data binary")
    plain = {(r["i"], r["key"], bytes(r["data"])) for r in left.join(right, "key", "left").collect()}
    for hot_bytes, salts in ((5000, 5), (1, 6), (10**9, 1)):
        joined = salted_left_join(left, right, "key", ["i"], 1000, "data", hot_bytes)
        assert {(r["i"], r["key"], bytes(r["data"])) for r in joined.collect()} == plain
        copies = [line for line in joined._jdf.queryExecution().toString().splitlines() if "sequence" in line]
        assert copies  # right rows are copied by salts
        hot = left.groupBy("key").count().join(right, "key").selectExpr("key", "least(count, ceil(count * length(data) / %d)) as n" % hot_bytes)
        assert {r["key"]: r["n"] for r in hot.collect()}["large"] == salts


def test_every_hot_key_is_salted(spark):
    left = spark.range(20_000).selectExpr("id as i", "id % 5000 as key")
    right = spark.range(5000).selectExpr("id as key", "id * 2 as v")
    got = salted_left_join(left, right, "key", ["i"], hot_rows=3)
    assert got.where("v = key * 2").count() == 20_000


@pytest.fixture
def as_planned(spark):
    """Shuffled joins that Spark does not change while it runs."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("sent", [1, 1000])
def test_no_row_moves_by_a_hot_key_alone(spark, as_planned, monkeypatch, sent):
    monkeypatch.setattr("genflow.operators.joins.SENT_KEYS", sent, raising=False)
    left = spark.range(8000).selectExpr("id as i", "case when id % 4 = 3 then null when id % 2 = 0 then -1 else id % 100 end as key")
    right = spark.range(-1, 50).selectExpr("id as key", "id * 2 as v")
    joined = salted_left_join(left, right, "key", ["i"], hot_rows=10)
    got = sorted(map(tuple, joined.select("i", "key", "v").collect()), key=str)
    assert got == sorted(map(tuple, left.join(right, "key", "left").select("i", "key", "v").collect()), key=str)
    plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
    by_key = [below for line, below in zip(plan, plan[1:]) if "Exchange hashpartitioning(key" in line and "_salt" not in line]
    assert by_key and not any(re.search(r"\bi#\d", below) for below in by_key), by_key
    dealt = joined.groupBy((F.col("key") == -1).alias("hot"), F.spark_partition_id().alias("part")).count().collect()
    assert all(r["count"] < 1500 for r in dealt), dealt  # of 4000 rows of the hot key and 2000 without a key


def test_many_endpoints(spark):
    dim_ = spark.range(50_000).selectExpr("id as endpoint", "id % 4 as weight")
    rows = assign_endpoints(spark.range(20_000).withColumnRenamed("id", "index"), dim_)
    upper = list(accumulate(i % 4 for i in range(50_000)))
    got = rows.collect()
    assert len(got) == 20_000
    assert all(r["endpoint"] == bisect_right(upper, r["draw"]) for r in got)
