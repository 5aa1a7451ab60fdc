"""Calling the user's model once per batch inside Spark tasks.

The model is the caller's function; only these steps leave the JVM. Store the
plan before scoring and the scores before using them twice: every evaluation
of a DataFrame calls the model again.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.attempts import REWRITE_POLICY, RetryPolicy
from ..functions.logs import ERROR_CODES
from ..functions.prompts import build_enhance_request, parse_enhance_response
from .failover import Endpoint, EndpointPool
from .joins import salted_left_join

_CODES = {name: code for code, name in ERROR_CODES}
UNKNOWN, API_CONNECTION, API_TIMEOUT = _CODES["UNKNOWN"], _CODES["API_CONNECTION_ERROR"], _CODES["API_TIMEOUT_ERROR"]
#: What an unusable reply counts as.
UNUSABLE = _CODES["GENERATION_ERROR"]
ERROR = "_error"
ATTEMPTS = "attempts"
# Results leave a task in batches of this many rows or bytes, whichever comes first.
OUT_ROWS, OUT_BYTES = 1_000, 32 << 20
#: Groups that may be done before the oldest call ends, per thread.
AHEAD = 16
ATTEMPT_TYPE = ("array<struct<attempt int, endpoint string, key_id int, ts timestamp, event_id bigint, ok boolean, code string, "
                "error string, wait double, errors bigint>>")


def threads_per_process(max_global: int = 16, procs: int = 4) -> int:
    """Calls one process may have in flight."""
    return max(1, max_global // procs)


def error_text(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"


def error_code(error: BaseException) -> str:
    """The code an error carries, else that of timeouts and lost connections, else 'E0000'."""
    carried = getattr(error, "code", None)
    if isinstance(carried, str) and carried:
        return carried
    return API_TIMEOUT if isinstance(error, TimeoutError) else API_CONNECTION if isinstance(error, OSError) else UNKNOWN


def batch_then_single(score: Callable[[list[dict]], Sequence], rows: list[dict]) -> list[tuple]:
    """(result, error) per row: the whole batch first, each row alone if that fails.

    A reply of another length than the batch counts as a failure.
    """
    return [answer[:2] for answer in tried_batch(with_retry(_checked(score), RetryPolicy()), rows)]


def tried_batch(tried: Callable, rows: list[dict]) -> list[tuple]:
    """(result, error, tries) per row, of a scorer wrapped by :func:`with_retry`; a row's tries are those of all calls it was in."""
    results, error, tries = tried(rows)
    if error is None:
        return [(r, None, tries) for r in results]
    if len(rows) == 1:
        return [(None, error, tries)]
    return [(result, error, [*tries, *more]) for row in rows for result, error, more in tried_batch(tried, [row])]


def with_retry(call: Callable, policy: RetryPolicy, sleep: Callable[[float], None] = time.sleep,
               accept: Callable[[object], bool] | None = None, pool: EndpointPool | None = None, aimed: bool = True) -> Callable:
    """Wrap ``call`` so that it returns (result, error, attempts).

    A raised error waits before the next try; a reply that ``accept`` refuses
    is tried again at once. With a ``pool`` every try goes to the endpoint
    drawn for it by live health: ``call`` gets its :class:`~.failover.Target`
    as last argument, unless it is not ``aimed``. ``attempts`` lists every try
    for the attempt log. A result is None where the last error was raised.
    """
    def run(*args):
        tries, result, error = [], None, None
        for attempt in range(policy.attempts):
            wait, code = 0.0, None
            place, target = pool.pick() if pool else (None, None)
            try:
                result = call(*args, target) if pool and aimed else call(*args)
                error = None if accept is None or accept(result) else "unusable reply"
                code = None if error is None else UNUSABLE
            except Exception as raised:
                result, error, code = None, error_text(raised), error_code(raised)
                wait = policy.wait(attempt)
            event = pool.record(place, error is None) | {"key_id": target.key_id} if pool else {}
            tries.append({"attempt": attempt, "ok": error is None, "error": error, "code": code, "wait": wait, **event})
            if error is None:
                break
            if wait:
                sleep(wait)
        return result, error, tries

    return run


def in_flight(call: Callable, items: Iterable, threads: int, ahead: int | None = None) -> Iterator:
    """Results of ``call`` in item order, with at most ``threads`` calls at a time.

    The next call starts when any call ends, whichever it is; ``items`` are
    taken in the caller's thread. One slow call idles no other until ``ahead``
    later results wait for it, which bounds what is held.
    """
    if threads <= 1:
        yield from map(call, items)
        return
    most = threads + (AHEAD * threads if ahead is None else ahead)
    pool = ThreadPoolExecutor(max_workers=threads)
    try:
        held = deque()
        for item in items:
            held.append(pool.submit(call, item))
            while held and (len(held) >= most or held[0].done()):
                yield held.popleft().result()
        while held:
            yield held.popleft().result()
    finally:
        pool.shutdown(wait=True, cancel_futures=True)


def bounded(call: Callable, items: Sequence, threads: int) -> list:
    """Results of ``call`` in item order with at most ``threads`` calls in flight."""
    return list(in_flight(call, items, threads))


def _groups(batches: Iterator[pa.RecordBatch], size: int, batch_cols: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of at most ``size`` rows; with ``batch_cols`` a run never mixes two planned batches."""
    held: list[pa.RecordBatch] = []

    def flushed():
        table = pa.Table.from_batches(held)
        held.clear()
        return table

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in batch_cols))) or [()] * batch.num_rows
        start, taken = 0, sum(b.num_rows for b in held)
        for i, label in enumerate(labels):
            if taken and (taken >= size or label != last):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield flushed()
                start, taken = i, 0
            taken, last = taken + 1, label
        held.append(batch.slice(start))
    if held:
        yield flushed()


def score_batches(df: DataFrame, factory: Callable[[], Callable], schema: str, batch_size: int = 1,
                  key: Sequence[str] = ("index",), batch_cols: Sequence[str] = (), threads: int = 1,
                  procs: int | None = None, columns: Sequence[str] | None = None, policy: RetryPolicy | None = None,
                  endpoints: Sequence[Endpoint] | None = None, log: bool = False, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Score every row: ``factory()`` once per task (only if it has rows), then one call per batch.

    The scorer takes a list of row dicts (of ``columns``, or all) and returns
    one dict (or None) per row. ``schema`` describes those results; ``key``
    columns and ``_error`` are added. A failing row is an error row. With
    ``batch_cols`` rows of one planned batch meet in one task and are called
    together. ``procs`` spreads a small input over that many tasks; up to
    ``threads`` calls run at once in each.

    ``policy`` retries calls. With ``endpoints`` each try goes to one of them,
    drawn by the health the task has seen, and the scorer takes its target as
    second argument. ``log`` adds ``attempts``, every try a row was part of.
    Key columns pass through as Arrow data and are never made into rows.
    """
    result_fields = list(T.StructType.fromDDL(schema))
    names = [f.name for f in result_fields]
    extra = [T.StructField(ERROR, T.StringType())]
    if log:
        extra.append(T.StructField(ATTEMPTS, T.StructType.fromDDL(f"a {ATTEMPT_TYPE}")["a"].dataType))
    out_schema = T.StructType([df.schema[k] for k in key] + result_fields + extra)
    made_schema = to_arrow_schema(T.StructType(result_fields + extra))
    seen = list(df.columns if columns is None else columns)
    if batch_cols:
        spread = df.repartition(procs, *batch_cols) if procs else df.repartition(*batch_cols)
        df = spread.sortWithinPartitions(*batch_cols, *key)
    elif procs:
        df = df.repartition(procs)
    needed = list(dict.fromkeys([*key, *seen, *batch_cols]))
    rules = policy or RetryPolicy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tried = None

        def groups():
            nonlocal tried
            for group in _groups(batches, max(1, batch_size), batch_cols):
                if tried is None:
                    tried = with_retry(_checked(factory()), rules, sleep, None, *_pool(endpoints))
                yield group

        def answer(group: pa.Table) -> tuple[pa.Table, list[tuple]]:
            return group.select(list(key)), tried_batch(tried, group.select(seen).to_pylist())

        kept, made, held_bytes = [], [], 0
        for keys, answers in in_flight(answer, groups(), threads):
            kept.append(keys)
            for result, error, tries in answers:
                if result is None and error is None:
                    error = "no output"
                values = [(result or {}).get(name) for name in names]
                held_bytes += sum(len(v) for v in values if isinstance(v, (str, bytes)))
                made.append([*values, error, *([tries] if log else [])])
            if len(made) >= OUT_ROWS or held_bytes >= OUT_BYTES:
                yield from _out(kept, made, made_schema)
                kept, made, held_bytes = [], [], 0
        if made:
            yield from _out(kept, made, made_schema)

    return df.select(*needed).mapInArrow(run, out_schema)


def _checked(scorer: Callable) -> Callable:
    def call(rows, *target):
        results = list(scorer(rows, *target))
        if len(results) != len(rows):
            raise ValueError(f"{len(results)} results for {len(rows)} rows")
        return results

    return call


def _out(kept: list[pa.Table], made: list[list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    table = pa.concat_tables(kept).combine_chunks()
    for values, field in zip(zip(*made), schema):
        table = table.append_column(field, pa.array(values, field.type))
    yield from table.to_batches()


def score_edits(df: DataFrame, factory: Callable[[], Callable], batch_size: int = 1, key: Sequence[str] = ("index",),
                images: str = "images", instruction: str = "instruction", batch_cols: Sequence[str] = (),
                threads: int = 1, procs: int | None = None, **tries) -> DataFrame:
    """Edit images: the scorer takes (images, instruction) pairs and returns a list of outputs each.

    Only the first output is kept; none at all is a failed row. ``tries`` are
    the ``policy``, ``endpoints`` and ``log`` of :func:`score_batches`.
    """
    def edits():
        model = factory()

        def score(rows, *target):
            replies = list(model([(r[images] or [], r[instruction]) for r in rows], *target))
            if len(replies) != len(rows):
                raise ValueError(f"{len(replies)} results for {len(rows)} rows")
            return [{"image": bytes(outputs[0])} if outputs else None for outputs in replies]

        return score

    return score_batches(df, edits, "image binary", batch_size, key, batch_cols, threads, procs, [images, instruction], **tries)


def _rewriter(call_factory, style: str, policy: RetryPolicy, sleep, endpoints: Sequence[Endpoint] | None):
    def make():
        call = call_factory()
        accept = _usable_json if style == "qwen_image_edit" else None
        tried = with_retry(call, policy, sleep, accept, *_pool(endpoints))

        def score(rows):
            out = []
            for row in rows:
                raw, error, attempts = tried(row["request"])
                out.append({"raw": raw, "call_error": error, "attempts": attempts})
            return out

        return score

    return make


def _pool(endpoints: Sequence[Endpoint] | None) -> tuple[EndpointPool, bool]:
    """This task's endpoints, and whether calls are told where to go; without any, tries are noted for one called 'default'."""
    return EndpointPool(list(endpoints or [Endpoint("default")]), TaskContext.get().partitionId()), bool(endpoints)


def _usable_json(raw) -> bool:
    import json

    text = (raw or "").strip()
    for fence in ("```json", "```"):
        text = text.removeprefix(fence)
    try:
        json.loads(text.removesuffix("```").strip())
        return True
    except ValueError:
        return False


def enhance_prompts(df: DataFrame, call_factory: Callable[[], Callable[..., str]], style: str, system: dict[str, str],
                    prompt: str = "instruction", images: str | None = None, model: str = "",
                    key: Sequence[str] = ("index",), policy: RetryPolicy = REWRITE_POLICY, dedupe: bool = False,
                    sleep: Callable[[float], None] = time.sleep, threads: int = 1,
                    procs: int | None = None, endpoints: Sequence[Endpoint] | None = None) -> DataFrame:
    """Rewrite prompts: request column, the caller's call, reply column.

    Adds ``enhanced``, ``raw``, ``call_error`` and ``attempts``; a failed call
    keeps the original prompt. ``dedupe`` calls equal requests once, which is
    only right for a service that always answers alike. With ``endpoints`` each
    try goes to one of them and the call takes its target as second argument.
    Only the request is made into Python objects; other columns pass by.
    """
    asked = df.withColumn("request", build_enhance_request(prompt, style, system, images, model))
    make = _rewriter(call_factory, style, policy, sleep, endpoints)
    reply_schema = f"raw string, call_error string, attempts {ATTEMPT_TYPE}"
    calling = {"threads": threads, "procs": procs, "columns": ["request"]}
    if dedupe:
        asked = asked.withColumn("_request_id", F.md5("request"))
        calls = asked.groupBy("_request_id").agg(F.first("request").alias("request"))
        replies = score_batches(calls, make, reply_schema, 1, ["_request_id"], **calling).drop(ERROR)
        answered = salted_left_join(asked, replies, "_request_id", key).drop("_request_id")
    else:
        carried = [c for c in asked.columns if c != "request"]
        answered = score_batches(asked, make, reply_schema, 1, carried, **calling).drop(ERROR)
    usable = F.when(F.col("call_error").isNull(), F.col("raw"))
    return answered.withColumn("enhanced", parse_enhance_response(usable, prompt, style)).drop("request")


def attempt_log(replies: DataFrame, key: str = "index", task: str | None = None) -> DataFrame:
    """One row per try, from the ``attempts`` column of a scored table: what the attempt-log analytics read.

    ``endpoint``, ``ts``, ``event_id`` (tells tries of one moment apart, rises
    inside a process), ``ok``, ``code``, and the number of the try, its key,
    error, wait and the errors then outstanding on the endpoint as the process
    saw them. ``task`` renames the key.
    """
    rows = replies.select(F.col(key).alias(task or key), F.explode("attempts").alias("a"))
    return rows.select(task or key, "a.*")
