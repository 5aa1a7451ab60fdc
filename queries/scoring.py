"""Scoring with stand-in models: whole tables, deterministic replies."""

from __future__ import annotations

import json
import hashlib

from pyspark.sql import functions as F

from genflow.functions.attempts import RetryPolicy
from genflow.operators.attempts import endpoint_health, resolve_attempts, retry_stats
from genflow.operators.failover import EVENT_BITS, Endpoint
from genflow.operators.registry import lookup, register
from genflow.operators.scoring import (
    attempt_log, enhance_prompts, score_batches, score_edits, threads_per_process,
)
from genflow.sinks.results import enhance_audit
from genflow.storage import stored

from .catalog import query, sql


def _digest(rows):
    return [{"length": len(r["instruction"]), "md5": hashlib.md5(r["instruction"].encode()).hexdigest()} for r in rows]


@register("digest")
def digest_model():
    """A stand-in for loading a model."""
    return _digest


def strict_model():
    def score(rows):
        # Refuses a whole batch for one bad row; gives nothing for every seventh.
        if any(r["index"] % 11 == 3 for r in rows):
            raise RuntimeError("bad row in batch")
        return [None if r["index"] % 7 == 0 else d for r, d in zip(rows, _digest(rows))]

    return score


@query("k1_score_batches", sql("tasks", "select index, cast(length(instruction) as integer) as length, md5(instruction) as md5, cast(null as varchar) as _error from tasks"))
def _(t):
    tasks = t.tasks().select("index", "instruction")
    return score_batches(tasks, lookup("digest"), "length int, md5 string", batch_size=16)


@query("k5_batch_then_single", sql("tasks", """select index, case when index % 11 <> 3 and index % 7 <> 0 then md5(instruction) end as md5,
    case when index % 11 = 3 then 'RuntimeError: bad row in batch' when index % 7 = 0 then 'no output' end as _error from tasks"""))
def _(t):
    tasks = t.tasks().selectExpr("index", "instruction", "index div 8 as batch")
    return score_batches(tasks, strict_model, "md5 string", batch_size=8, batch_cols=["batch"])


@query("k7_bounded_calls", sql("tasks", "select index, md5(instruction) as md5 from tasks"))
def _(t):
    tasks = t.tasks().select("index", "instruction")
    return score_batches(tasks, digest_model, "md5 string", batch_size=4, threads=threads_per_process(16, 4)).drop("_error")


def edit_model():
    def edit(pairs):
        # The first image behind the instruction; nothing when there is no image.
        return [[text.encode() + b"|" + images[0], b"second"] if images else [] for images, text in pairs]

    return edit


@query("k2_score_edits", """select page_id as index, case when page_id % 3 > 0 then md5(concat(url, '|', html)) end as image,
    case when page_id % 3 = 0 then 'no output' end as _error from pages""")
def _(t):
    pages = t.read("pages").select(
        F.col("page_id").alias("index"), F.col("url").alias("instruction"),
        F.expr("case when page_id % 3 = 0 then array() else array_repeat(encode(html, 'UTF-8'), cast(page_id % 3 as int)) end").alias("images"))
    return score_edits(pages, edit_model, batch_size=4).select("index", F.md5("image").alias("image"), "_error")


def rewriting_service():
    """Answers some requests in JSON, some in prose, and refuses some."""
    def call(request, target=None):
        asked = json.loads(request)["messages"][1]["content"][-1]["text"]
        prompt = asked.removeprefix("User Input: ").removesuffix("\n\nRewritten Prompt:")
        if len(prompt) % 5 == 0:
            raise ConnectionError("refused")
        if len(prompt) % 5 == 1:
            return "Sorry."
        return "```json\n" + json.dumps({"Rewritten": "new " + prompt}) + "\n```"

    return call


_SYSTEM = {"edit": "Rewrite."}
_NO_WAIT = {"policy": RetryPolicy(retries=2, delay=0.0)}


def rewritten(t, **options):
    tasks = t.read("documents").select(F.col("doc_id").alias("index"), F.col("text").alias("instruction"))
    return enhance_prompts(tasks, rewriting_service, "qwen_image_edit", _SYSTEM, model="gpt-4o", **_NO_WAIT, **options)


# chr(10), spaces, tabs and returns are what the texts can end with.
_REWRITTEN = """select doc_id as index, md5(case when length(text) % 5 < 2 then text
    else replace(rtrim(concat('new ', text), concat(' ', chr(10), chr(9), chr(13))), chr(10), ' ') end) as enhanced,
    case length(text) % 5 when 0 then 'ConnectionError: refused' when 1 then 'unusable reply' end as call_error,
    case when length(text) % 5 < 2 then 3 else 1 end as tries from documents"""


@query("k3_enhance_prompts", _REWRITTEN)
def _(t):
    return rewritten(t).select("index", F.md5("enhanced").alias("enhanced"), "call_error", F.size("attempts").alias("tries"))


@query("k3_enhance_distinct_requests", _REWRITTEN)
def _(t):
    return rewritten(t, dedupe=True).select("index", F.md5("enhanced").alias("enhanced"), "call_error", F.size("attempts").alias("tries"))


@query("k4_attempt_log", """select doc_id as index, cast(a as integer) as attempt, length(text) % 5 > 1 as ok,
    case length(text) % 5 when 0 then 'ConnectionError: refused' when 1 then 'unusable reply' end as error,
    case length(text) % 5 when 0 then 'E2001' when 1 then 'E1003' end as code
    from (select *, unnest(range(0, case when length(text) % 5 < 2 then 3 else 1 end)) as a from documents)""")
def _(t):
    return attempt_log(stored(rewritten(t), "rewrites")).select("index", "attempt", "ok", "error", "code")


SERVERS = [Endpoint("a", "http://a", ("k0", "k1"), 5), Endpoint("b", "http://b", ("k0",), 2), Endpoint("c", None, (), 1)]


@query("k4_failover_analytics", """select doc_id as task, length(text) % 5 > 1 as succeeded, case length(text) % 5 when 0 then 'E2001' when 1 then 'E1003' end as error,
    cast(case when length(text) % 5 < 2 then 3 else 1 end as bigint) as attempts_used, cast(case when length(text) % 5 < 2 then 3 else 1 end as bigint) as attempts,
    cast(case when length(text) % 5 < 2 then 3 else 0 end as bigint) as failures, true as servers_known, true as health_agrees from documents""")
def _(t):
    """Tries over several endpoints; their log gives outcomes (F4), retries (G12) and the health (G8) each process saw."""
    log = stored(attempt_log(stored(rewritten(t, endpoints=SERVERS), "rewrites"), task="task"), "tries").withColumnRenamed("errors", "seen")
    outcome = resolve_attempts(log.drop("attempt"), RetryPolicy(retries=2)).select("task", "succeeded", "error", "attempts_used")
    stats = retry_stats(log).select("task", "attempts", "failures")
    # Every process knows the health of its own calls only.
    pooled = log.withColumn("endpoint", F.concat_ws(":", F.shiftright("event_id", EVENT_BITS), "endpoint"))
    health = endpoint_health(pooled).groupBy("task").agg(
        F.bool_and(F.col("errors") == F.col("seen")).alias("health_agrees"),
        F.bool_and(F.substring_index("endpoint", ":", -1).isin([s.name for s in SERVERS])).alias("servers_known"))
    return outcome.join(stats, "task").join(health, "task")


def overloaded_model():
    """Refuses the first try of every batch that has an index divisible by five."""
    seen = set()

    def score(rows, target=None):
        first = rows[0]["index"]
        if any(r["index"] % 5 == 0 for r in rows) and (len(rows), first) not in seen:
            seen.add((len(rows), first))
            raise TimeoutError("overloaded")
        return _digest(rows)

    return score


@query("k1_retried_batches", sql("tasks", """select index, md5(instruction) as md5, cast(null as varchar) as _error,
    cast(case when max(cast(index % 5 = 0 as integer)) over (partition by index // 4) = 1 then 2 else 1 end as integer) as tries from tasks"""))
def _(t):
    tasks = t.tasks().selectExpr("index", "instruction", "index div 4 as batch")
    scored = score_batches(tasks, overloaded_model, "md5 string", 4, batch_cols=["batch"], policy=RetryPolicy(retries=1, delay=0.0),
                           endpoints=SERVERS, log=True)
    return scored.select("index", "md5", "_error", F.size("attempts").alias("tries"))


@query("b5_enhance_audit", """select md5(original) as original, md5(enhanced) as enhanced, case when raw = '' then '<empty>' else md5(raw) end as raw,
    error, mode, temperature, model, n_images from (select text as original, text as enhanced, '' as raw, 'None' as error, 'api' as mode,
      0.15::double as temperature, 'm' as model, 0 as n_images from documents where length(text) % 2 = 0
    union all select text, upper(source), source, 'late', 'api', 0.15::double, 'm', 0 from documents where length(text) % 2 = 1)""")
def _(t):
    rows = t.read("documents").selectExpr(
        "text as original", "case when length(text) % 2 = 0 then text else upper(source) end as enhanced",
        "case when length(text) % 2 = 1 then source else '' end as raw", "case when length(text) % 2 = 1 then 'late' end as error",
        "cast(null as int) as n_images")
    audit = enhance_audit(rows, "m", temperature=0.15).drop("ts")
    return audit.withColumns({"original": F.md5("original"), "enhanced": F.md5("enhanced"),
                              "raw": F.when(F.col("raw") == "<empty>", F.col("raw")).otherwise(F.md5("raw"))})
