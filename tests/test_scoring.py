"""Scoring, retries, whole jobs."""

import random
import threading
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from genflow.functions.attempts import RetryPolicy
from genflow.operators.images import regroup_images
from genflow.operators.registry import lookup, register, registered
from genflow.operators.requests import checked_requests, validate_requests
from genflow.operators.params import match_pattern_table
from genflow.operators.resume import attach_rows, filter_rows, load_rows, lookup_index, row_ranges
from genflow.operators.failover import Endpoint, EndpointPool
from genflow.operators.scoring import (
    batch_then_single, bounded, in_flight, score_batches, score_edits, threads_per_process, with_retry,
)
from genflow.plans import job
from genflow.plans.job import PlanOptions, finish_run, plan_tasks, run_plan, start_run
from genflow.sources.outputs import list_outputs, read_manifest
from genflow.sources.requests import parse_request
from genflow.sources.tasks import read_prompts_jsonl, read_tasks_parquet, single_prompt
from genflow.storage import stored


def test_batch_then_single():
    def score(rows):
        if any(r["i"] == 2 for r in rows):
            raise RuntimeError("two")
        return [{"v": r["i"]} for r in rows]

    rows = [{"i": i} for i in range(4)]
    assert batch_then_single(score, rows) == [({"v": 0}, None), ({"v": 1}, None), (None, "RuntimeError: two"), ({"v": 3}, None)]
    assert batch_then_single(lambda rows: rows[:1], rows) == [(r, None) for r in rows]
    assert batch_then_single(lambda rows: [], rows[:1])[0][1] == "ValueError: 0 results for 1 rows"


def test_retry_waits_and_attempts():
    calls, waits = [], []

    def call(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("no")
        return "ok"

    result, error, tries = with_retry(call, RetryPolicy(retries=3, delay=1.0), waits.append)("x")
    assert (result, error, waits, len(tries)) == ("ok", None, [1.0, 2.0], 3)
    assert [t["ok"] for t in tries] == [False, False, True]
    result, error, tries = with_retry(lambda: 1 / 0, RetryPolicy(retries=1), waits.append)()
    assert result is None and error.startswith("ZeroDivisionError") and len(tries) == 2
    waits.clear()
    result, error, tries = with_retry(lambda: "junk", RetryPolicy(retries=2), waits.append, lambda r: r != "junk")()
    assert (result, error, waits, len(tries)) == ("junk", "unusable reply", [], 3)


def test_bounded_keeps_order_and_limit():
    state = {"now": 0, "most": 0}
    lock = threading.Lock()

    def call(i):
        with lock:
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
        time.sleep(.01 * (5 - i % 5))
        with lock:
            state["now"] -= 1
        return i

    assert bounded(call, list(range(20)), 4) == list(range(20)) and state["most"] <= 4
    assert threads_per_process(16, 4) == 4 and threads_per_process(2, 4) == 1


def test_one_slow_call_idles_no_other():
    others = threading.Semaphore(0)

    def call(i):
        if i == 0:  # ends only after thirty others have
            for _ in range(30):
                assert others.acquire(timeout=20)
        else:
            others.release()
        return i

    assert list(in_flight(call, iter(range(60)), 4)) == list(range(60))


def test_calls_in_flight_hold_no_more_than_they_may():
    taken, gate = [], threading.Event()

    def items():
        for i in range(100):
            taken.append(i)
            if i == 11:
                gate.set()  # the first call may end once as many are taken as may be held
            yield i

    def call(i):
        if i == 0:
            assert gate.wait(20)
        return i

    running = in_flight(call, items(), 4, ahead=8)
    assert next(running) == 0 and len(taken) <= 14
    running.close()
    with pytest.raises(ZeroDivisionError):
        list(in_flight(lambda i: 1 // i, [1, 0, 1], 3))


def test_endpoints_are_drawn_by_weight_and_health():
    pool = EndpointPool([Endpoint(str(i), keys=("x", "y"), weight=w) for i, w in enumerate((16, 1, 7, 3, 5))], seed=3)
    drawn = [pool.pick() for _ in range(3200)]
    share = [sum(i == k for k, _ in drawn) / 3200 for i in range(5)]
    assert all(abs(s - w / 32) < 0.04 for s, w in zip(share, (16, 1, 7, 3, 5)))
    assert [t.key_id for i, t in drawn if i == 0][:4] == [0, 1, 0, 1]
    for errors, left in ((1, 8), (2, 4), (3, 2), (4, 1), (5, 1)):
        assert pool.record(0, False)["errors"] == errors and pool.weights()[0] == left
    assert pool.record(1, False)["errors"] == 1 and pool.weights()[1] == 1
    for left in (1, 2, 4, 8, 16, 16):
        pool.record(0, True)
        assert pool.weights()[0] == left
    assert pool.weights() == [16, 1, 7, 3, 5] and sum(pool._at(d) == 2 for d in range(32)) == 7
    with pytest.raises(ValueError, match="no endpoints"):
        EndpointPool([])


def test_many_endpoints_find_their_own_share():
    weights = [1 + i % 7 for i in range(3000)]
    pool = EndpointPool([Endpoint(str(i), weight=w) for i, w in enumerate(weights)])
    low = 0
    for i, w in enumerate(weights):
        if i % 97 == 0:
            assert pool._at(low) == pool._at(low + w - 1) == i
        low += w
    assert pool._total() == low


def test_tries_go_elsewhere_when_an_endpoint_fails(spark):
    def factory():
        def score(rows, target):
            if target.endpoint.name == "down":
                raise ConnectionError("down")
            return [{"by": f"{target.endpoint.name}/{target.key}"} for _ in rows]

        return score

    servers = [Endpoint("down", weight=8), Endpoint("up", "http://up", ("k",), 8)]
    rows = score_batches(spark.range(60).repartition(2), factory, "by string", 1, ["id"], policy=RetryPolicy(retries=40, delay=0.0),
                         endpoints=servers, log=True, threads=3).collect()
    assert {r["by"] for r in rows} == {"up/k"} and all(r["_error"] is None for r in rows)
    tries = [a for r in rows for a in r["attempts"]]
    assert all(r["attempts"][-1]["ok"] and not any(a["ok"] for a in r["attempts"][:-1]) for r in rows)
    assert {a["code"] for a in tries if not a["ok"]} == {"E2001"} and len({a["event_id"] for a in tries}) == len(tries)
    assert sum(a["endpoint"] == "down" for a in tries) < sum(a["endpoint"] == "up" for a in tries)  # its weight falls
    assert {a["key_id"] for a in tries} == {None, 0}


def test_edits_with_a_policy(spark):
    def factory():
        state = {"n": 0}

        def edit(pairs):
            state["n"] += 1
            if state["n"] % 2:
                raise TimeoutError("busy")
            return [[b"made"] for _ in pairs]

        return edit

    df = spark.range(4).selectExpr("id as index", "array(cast('i' as binary)) as images", "'do' as instruction", "'wide' as other").coalesce(1)
    rows = score_edits(df, factory, 2, policy=RetryPolicy(retries=1, delay=0.0), log=True).collect()
    assert [bytes(r["image"]) for r in rows] == [b"made"] * 4
    assert [[(a["ok"], a["code"]) for a in r["attempts"]] for r in rows] == [[(False, "E2002"), (True, None)]] * 4


def test_registry():
    register("One", lambda: None)
    assert lookup("one")() is None and "one" in registered()
    with pytest.raises(ValueError, match="unknown scorer 'two'; known: .*one"):
        lookup("two")


def test_score_batches_respects_planned_batches(spark):
    def factory():
        def score(rows):
            return [{"seen": len(rows), "kinds": len({r["batch"] for r in rows})} for r in rows]

        return score

    df = spark.range(100).select(F.col("id").alias("index"), F.floor(F.col("id") / 7).alias("batch"))
    rows = score_batches(df.repartition(9), factory, "seen int, kinds int", 7, ["index"], ["batch"]).collect()
    assert len(rows) == 100 and {r["kinds"] for r in rows} == {1}
    assert all(r["seen"] == (7 if r["index"] < 98 else 2) for r in rows)


def test_factory_is_not_called_without_rows(spark):
    def factory():
        raise RuntimeError("loaded for nothing")

    assert score_batches(spark.range(5).where("id > 9"), factory, "v int", key=["id"]).count() == 0


def test_job_and_resume(spark, tmp_path):
    def model():
        """Writes the instruction back; refuses one of them."""
        def score(rows):
            if any(r["instruction"] == "refuse" for r in rows):
                raise RuntimeError("refused")
            return [{"image": r["instruction"].encode()} for r in rows]

        return score

    inputs, out = tmp_path / "in", tmp_path / "out"
    inputs.mkdir()
    out.mkdir()
    for f in range(3):
        pq.write_table(pa.table({
            "index": list(range(f * 10, f * 10 + 10)),
            "instruction": ["refuse" if i == 4 and f == 1 else f"do {f} {i}" for i in range(10)],
            "output_path": [None if i % 2 else f"d{f}//n{i}" for i in range(10)]}), inputs / f"t{f}.parquet")
    (out / "000001.png").write_bytes(b"there")
    tasks = read_tasks_parquet(spark, str(inputs))
    options = PlanOptions(nodes=2, procs=2, batch_size=4, name_col="output_path")
    narrow = tasks.select("index", "output_path", "_file", "_row", "_pos")
    plan = plan_tasks(narrow, list_outputs(spark, str(out)), options)
    rows = plan.orderBy("_pos").collect()
    assert [r["index"] for r in rows] == [i for i in range(30) if i != 1]
    assert [r["_pos"] for r in rows] == list(range(29))
    results = run_plan(plan, tasks, model, str(out), str(tmp_path / "results"), 4, ["instruction"])
    done = {r["index"]: (r["output_image"], r["_error"]) for r in results.collect()}
    assert done[14] == (None, "RuntimeError: refused") and done[0] == ("d0/n0.png", None) and len(done) == 29
    assert (out / "d2/n8.png").read_bytes() == b"do 2 8"
    again = plan_tasks(narrow, list_outputs(spark, str(out)), options)
    assert [r["index"] for r in again.collect()] == [14]
    assert [r["index"] for r in plan_tasks(narrow, read_manifest(spark, str(tmp_path / "results/manifest")), options).orderBy("index").collect()] == [1, 14]
    everything = plan_tasks(narrow, list_outputs(spark, str(out)), PlanOptions(resume=False, rows="5:8,0"))
    assert sorted(r["index"] for r in everything.collect()) == [0, 5, 6, 7]
    nothing = plan_tasks(narrow.where("index < 4"), list_outputs(spark, str(out)), options)
    assert run_plan(nothing, tasks, None, str(out), str(tmp_path / "r2"), columns=["instruction"]).count() == 0


def test_prompt_job_with_several_images(spark, tmp_path):
    def painter():
        return lambda rows: [{"image": f"{r['prompt']}".encode()} for r in rows]

    prompts, out = tmp_path / "p.jsonl", tmp_path / "out"
    prompts.write_text('{"prompt": "cat", "output_path": "pets/cat"}\n\n"dog"\n')
    (out / "pets").mkdir(parents=True)
    (out / "pets" / "cat_01.png").write_bytes(b"there")
    tasks = read_prompts_jsonl(spark, str(prompts), ("prompt", "output_path"))
    options = PlanOptions(n=3, strict=True, name_col="output_path", batch_size=2)
    plan = plan_tasks(tasks.select("index", "output_path", "_file", "_row", "_pos"), list_outputs(spark, str(out)), options)
    results = run_plan(plan, tasks, painter, str(out), str(tmp_path / "results"), 2, ["prompt"])
    made = sorted((r["index"], r["sub"], r["output_image"]) for r in results.collect())
    assert made == [(0, 0, "pets/cat_00.png"), (0, 2, "pets/cat_02.png")] + [(2, k, f"000002_{k:02d}.png") for k in range(3)]
    assert (out / "pets/cat_02.png").read_bytes() == b"cat" and (out / "pets/cat_01.png").read_bytes() == b"there"
    assert plan_tasks(single_prompt(spark, "x"), None).select("index", "expected", "_pos").collect() == [(0, "000000.png", 0)]


def test_nulls_and_integers_reach_the_scorer(spark):
    def factory():
        return lambda rows: [{"seen": repr((r["sub"], r["note"]))} for r in rows]

    df = spark.createDataFrame([(1, None, None), (2, 5, "n")], "index long, sub int, note string")
    rows = score_batches(df, factory, "seen string", 2, ["index", "sub"]).orderBy("index").collect()
    assert [(r["sub"], r["seen"]) for r in rows] == [(None, "(None, None)"), (5, "(5, 'n')")]
    spread = score_batches(spark.range(40), factory=lambda: lambda rows: [{"v": 1} for _ in rows], schema="v int", key=["id"], procs=5)
    assert spread.count() == 40


def test_row_lookups(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "index long, v string, _pos long")
    wanted = spark.createDataFrame([(1,), (1,), (9,)], "index long")
    assert sorted(r["v"] for r in load_rows(rows, wanted).collect()) == ["a", "c"]
    assert [r["v"] for r in lookup_index(rows, 1).collect()] == ["a"] and lookup_index(rows, 7).count() == 0
    got = {(r["index"], r["v"], r["_error"]) for r in attach_rows(wanted, rows).collect()}
    assert got == {(1, "c", None), (9, None, "Skipping index 9: row not found")}
    assert [r["v"] for r in filter_rows(rows, " 2 ,, :1").orderBy("_pos").collect()] == ["a", "c"]
    assert filter_rows(rows, "").count() == 0


def test_many_row_ranges_take_one_search(spark):
    rng = random.Random(3)
    rows = spark.range(30_000).selectExpr("if(id % 1000 = 999, null, id) as _pos")
    lows = [rng.randrange(30_000) for _ in range(10_000)]
    expression = ", ".join(f"{a}:{a + rng.randrange(4)}" if a % 3 else str(a) for a in lows) + ",29990:"
    ranges = row_ranges(expression)
    assert all(a < b for a, b in ranges) and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    wanted = {p for a, b in ranges for p in range(a, min(b, 30_000))}
    got = {r["_pos"] for r in filter_rows(rows, expression).collect()}
    assert got == {p for p in wanted if p % 1000 != 999} and len(ranges) > 1000
    assert row_ranges("5:3, 7:7,, 1:4,3:6,6,-2:0") == [(-2, 0), (1, 7)]
    assert row_ranges(":") == [(0, 2**63 - 1)]
    for wrong in ("a", "1:2:3", "1-2", "1.5"):
        with pytest.raises(ValueError, match="no row or range"):
            row_ranges(wrong)


def test_pattern_tables(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcAB.") for _ in range(n))
    patterns = [(i if rng.random() < 0.9 else i // 2, word(rng.randrange(1, 7)), f"v{i}") for i in range(300)] + [(9, None, "none"), (5000, "", "any")]
    names = [word(rng.randrange(0, 14)) for _ in range(200)] + [None, ""]
    for listed in (patterns, patterns[:-1], []):
        table = spark.createDataFrame(listed, "ordinal int, pattern string, value string")
        df = spark.createDataFrame([(n, "x") for n in names], "name string, matched string")
        got = [(r["name"], r["matched"]) for r in match_pattern_table(df, table).collect()]
        want = [(n, None if n is None else min(((o, v) for o, p, v in listed if p is not None and p.lower() in n.lower()), default=(0, None))[1]) for n in names]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_a_name_meets_no_pattern_that_it_does_not_contain(spark):
    # All patterns begin alike and each is listed 40 times: names look their own pieces up and are held against no list.
    patterns = spark.range(20_000).selectExpr("id as ordinal", "concat('abcabc', id % 500, 'xyz') as pattern", "concat('v', id) as value")
    names = spark.range(2_000).selectExpr("id", "concat('-ABCABC', id, 'XYZ-') as name")
    found = match_pattern_table(names, patterns)
    assert {r["id"]: r["matched"] for r in found.collect()} == {i: f"v{i}" if i < 500 else None for i in range(2000)}
    assert "contains(" not in found._jdf.queryExecution().toString().lower()


def test_regroup_rules(spark):
    refs = spark.createDataFrame([(1, 1, b"b"), (1, 0, b"a"), (2, 0, None), (2, 1, b"c"), (3, 0, None)], "index long, ref_pos int, data binary")
    strict = {r["index"]: (r["images"] and [bytes(b) for b in r["images"]], r["_error"]) for r in regroup_images(refs).collect()}
    assert strict == {1: ([b"a", b"b"], None), 2: (None, "failed to load images"), 3: (None, "failed to load images")}
    loose = {r["index"]: [bytes(b) for b in r["images"]] for r in regroup_images(refs, strict=False).collect()}
    assert loose == {1: [b"a", b"b"], 2: [b"c"], 3: []}


BODIES = [
    ("t2i", '{"prompt": "p"}', 200), ("t2i", '{"prompt": ""}', 200), ("t2i", "{}", 422), ("t2i", "nope", 422), ("t2i", '["prompt"]', 422),
    ("edit", '{"prompt": ""}', 422), ("edit", '{"prompt": "p"}', 422), ("edit", '{"prompt": "p", "images": [{}]}', 422),
    ("edit", '{"prompt": "p", "images": [{"image_url": "http://x"}]}', 200),
    ("edit", '{"prompt": "p", "images": [{"file_id": "f"}]}', 400),
    ("edit", '{"prompt": "p", "images": [{"image_url": "http://x", "file_id": "f"}]}', 200),
    ("edit", '{"prompt": "p", "images": [{"image_url": "abc"}, {"file_id": "f"}]}', 400),
    ("edit", '{"prompt": "p", "images": [{"image_url": "aGk="}], "mask": {"image_url": "abc"}}', 400),
    ("edit", '{"prompt": "p", "images": [{"image_url": "aGk="}], "n": -2, "output_format": "JPEG", "size": "3x4"}', 200),
]


def test_request_checks(spark):
    df = spark.createDataFrame([(i, k, b) for i, (k, b, _) in enumerate(BODIES)], "i int, kind string, body string")
    df = df.withColumn("request", parse_request("body"))
    rows = checked_requests(df).orderBy("i").collect()
    assert [r["_status"] for r in rows] == [s for _, _, s in BODIES]
    assert "not a valid URL" in rows[11]["_detail"] and rows[0]["_detail"] is None
    assert (rows[13]["_n"], rows[13]["_format"], rows[13]["_width"], rows[13]["_height"]) == (1, "jpeg", 3, 4)
    ok, bad = validate_requests(df, mode="edit")
    assert ok.where("kind = 't2i'").count() == 0 and ok.count() + bad.count() == len(BODIES)
    assert bad.where("kind = 't2i' and _status = 400").count() == 2


def test_a_failed_run_repeats_no_recorded_call(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    tasks = spark.range(40).selectExpr("id as index", "concat('p', id) as prompt")
    out, results = str(tmp_path / "out"), str(tmp_path / "results")

    def painter(broken):
        def factory():
            def paint(rows):
                for row in rows:
                    if broken and row["prompt"] == "p17":
                        raise SystemExit("the worker dies")
                    with open(calls / row["prompt"], "a") as log:
                        log.write("x")
                return [{"image": row["prompt"].encode()} for row in rows]
            return paint
        return factory

    def left():
        done = read_manifest(spark, results + "/manifest") if (tmp_path / "results" / "manifest").exists() else None
        return stored(plan_tasks(tasks, done, PlanOptions(batch_size=2)), "plan")

    with pytest.raises(Exception):
        run_plan(left(), tasks, painter(True), out, results, 2, ["prompt"], chunk_rows=5)
    recorded = {r["path"] for r in read_manifest(spark, results + "/manifest").collect()} if (tmp_path / "results" / "manifest").exists() else set()
    before = {p.name: len(p.read_text()) for p in calls.iterdir()}
    rows = run_plan(left(), tasks, painter(False), out, results, 2, ["prompt"], chunk_rows=5)
    assert rows.count() == 40 - len(recorded) and rows.where("output_image is null").count() == 0
    after = {p.name: len(p.read_text()) for p in calls.iterdir()}
    again = {f"p{int(path.split('.')[0])}" for path in recorded}
    assert len(after) == 40 and all(after[p] == before[p] for p in again)


def counting_painter(folder):
    def factory():
        def paint(rows):
            for row in rows:
                with open(folder / row["prompt"], "a") as log:
                    log.write("x")
            return [{"image": row["prompt"].encode()} for row in rows]
        return paint
    return factory


@pytest.mark.parametrize("index", ["id", "cast(5 as bigint)", "nullif(id % 3, 0)", "cast(null as bigint)"])
def test_one_call_and_one_result_per_task_whatever_the_index(spark, tmp_path, index):
    calls = tmp_path / "calls"
    calls.mkdir()
    tasks = spark.range(30).selectExpr(f"{index} as index", "concat('p', id) as prompt")
    plan = stored(plan_tasks(tasks, None, PlanOptions(batch_size=4)), "plan")
    rows = run_plan(plan, tasks, counting_painter(calls), str(tmp_path / "out"), str(tmp_path / "results"), 4, ["prompt"], chunk_rows=9)
    assert rows.count() == 30 and {p.name: p.read_text() for p in calls.iterdir()} == {f"p{i}": "x" for i in range(30)}


def test_narrow_plans_of_tables_made_in_place(spark, tmp_path):
    tasks = spark.range(6).selectExpr("nullif(id, 3) as index", "concat('p', id) as prompt")
    plan = stored(plan_tasks(tasks.select("index"), None), "plan")
    rows = run_plan(plan, tasks, lambda: lambda rows: [{"image": r["prompt"].encode()} for r in rows], str(tmp_path / "out"),
                    str(tmp_path / "results"), columns=["prompt"])
    assert rows.count() == 6 and rows.where("_error is null").count() == 6  # the null index found its task too
    assert sorted(p.read_bytes() for p in (tmp_path / "out").iterdir()) == [f"p{i}".encode() for i in range(6)]
    twice = tasks.unionAll(tasks)
    with pytest.raises(ValueError, match="more than once"):
        run_plan(stored(plan_tasks(twice.select("index"), None), "plan"), twice, None, str(tmp_path / "out"), str(tmp_path / "r2"), columns=["prompt"])


def test_a_run_is_finished_from_its_stored_work(spark, tmp_path):
    calls, out, results = tmp_path / "calls", str(tmp_path / "out"), str(tmp_path / "results")
    calls.mkdir()
    tasks = spark.range(50).selectExpr("id as index", "concat('p', id) as prompt")
    plan = stored(plan_tasks(tasks, None, PlanOptions(batch_size=2)), "plan")
    run_path = start_run(plan, tasks, results, ["prompt"], chunk_rows=10)
    paint = counting_painter(calls)

    def breaks():
        scorer = paint()

        def score(rows):
            if any(r["prompt"] == "p44" for r in rows):
                raise SystemExit("the worker dies")
            return scorer(rows)
        return score

    with pytest.raises(Exception):
        finish_run(spark, run_path, breaks, out, results, 2)
    committed = {r["chunk"] for r in spark.read.parquet(f"{run_path}/commits").where("step = 'scored'").collect()}
    before = {p.name: p.read_text() for p in calls.iterdir()}
    chunk_of = {r["prompt"]: r["chunk"] for r in spark.read.parquet(f"{run_path}/work").collect()}
    assert len(chunk_of) == 50 and len(set(chunk_of.values())) == 5
    rows = finish_run(spark, run_path, paint, out, results, 2)
    assert rows.count() == 50 and rows.where("output_image is null").count() == 0
    after = {p.name: p.read_text() for p in calls.iterdir()}
    assert all(after[p] == before[p] == "x" for p, chunk in chunk_of.items() if chunk in committed)
    again = finish_run(spark, run_path, None, out, results, 2)  # nothing left to call
    assert again.count() == 50


def test_each_chunk_reads_its_own_folder_only(spark, tmp_path, monkeypatch):
    tasks = spark.range(40).selectExpr("id as index", "concat('p', id) as prompt")
    plan = stored(plan_tasks(tasks, None, PlanOptions(batch_size=2)), "plan")
    seen = []

    def score(df, *args, **options):
        seen.append([f.rsplit("/", 2)[1] for f in df.inputFiles()])
        return score_batches(df, *args, **options)

    monkeypatch.setattr(job, "score_batches", score)
    run_plan(plan, tasks, lambda: lambda rows: [{"image": b"x"} for _ in rows], str(tmp_path / "out"), str(tmp_path / "results"), 2, ["prompt"], chunk_rows=8)
    assert len(seen) == 5 and all(len(set(folders)) == 1 for folders in seen) and len({f[0] for f in seen}) == 5


@pytest.mark.parametrize("index", ["xxhash64(id)", "cast(5 as bigint)", "nullif(id % 3, 0)"])
def test_tables_made_in_place_keep_every_row(spark, many_small_blocks, index):
    tasks = spark.range(500).selectExpr(f"{index} as index", "concat('p', id) as prompt")
    plan = plan_tasks(tasks, None, PlanOptions(nodes=2, procs=2, batch_size=8))
    rows = plan.collect()
    assert sorted(r["_pos"] for r in rows) == list(range(500)) and {r["_total"] for r in rows} == {500}


def test_plans_with_shared_images_and_colliding_names(spark):
    tasks = spark.range(60).selectExpr("id as index", "concat('img', id % 3) as image", "'m' as output_path")
    plan = plan_tasks(tasks.drop("output_path"), None, PlanOptions(nodes=2, batch_size=4, image_col="image")).collect()
    batches = {}
    for r in plan:
        batches.setdefault((r["node"], r["process"], r["batch"]), []).append(r["image"])
    assert len(plan) == 60 and all(len(set(b)) == 1 and len(b) <= 4 for b in batches.values())
    with pytest.raises(ValueError, match="m.png"):
        plan_tasks(tasks, None, PlanOptions(name_col="output_path", collisions="raise"))
