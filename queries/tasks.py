"""Task tables: readers, names, resume, positions, shards, batches, result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from genflow.functions.naming import (
    drop_blank, expected_output, normalize_output_path, output_filename, select_instruction, with_index,
)
from genflow.operators.order import dedupe_index, positions, source_positions
from genflow.operators.params import with_capabilities
from genflow.operators.reports import align_results, key_categories, key_category, shard_progress
from genflow.operators.resume import (
    attach_rows, completed, dataset_stats, filter_rows, load_rows, lookup_index, output_collisions, pending,
    reconcile_keys, with_done,
)
from genflow.operators.shards import (
    cannot_batch, expand_samples, pack_batches, pack_shared_image, shard_balanced, shard_ceil,
)
from genflow.plans.job import PlanOptions, plan_tasks
from genflow.sinks.blobs import write_named_blobs
from genflow.sinks.results import merge_results, read_progress, result_columns, save_progress, shard_suffix
from genflow.operators.images import load_image_bytes
from genflow.sources.logs import read_worker_logs
from genflow.sources.outputs import list_outputs
from genflow.sources.tasks import read_parquet_dir_reindexed, read_prompts, read_tasks, read_tasks_parquet
from genflow.storage import new_path, stored

from .catalog import Tables, query, sql


def normalized(view: str, expr: str, sub: str = "''") -> str:
    """SQL that adds ``normalized``, written with lists instead of the patterns under test."""
    return f"""select *, case when s is null or s = '' then null else base || {sub} || ext end as normalized from (
      select *, case when kept then left(path, length(path) - length(suffix)) else path end as base,
        case when kept then lower(suffix) else '.png' end as ext from (
      select *, coalesce(lower(suffix) in ('.png', '.jpg', '.jpeg')
          and replace(left(name, length(name) - length(suffix)), '.', '') <> '', false) as kept from (
      select *, case when contains(name, '.') then '.' || string_split(name, '.')[-1] else '' end as suffix from (
      select *, coalesce(parts[-1], '') as name, case when root || array_to_string(parts, '/') = '' then '.'
          else root || array_to_string(parts, '/') end as path from (
      select *, case when starts_with(s, '//') and not starts_with(s, '///') then '//'
            when starts_with(s, '/') then '/' else '' end as root,
          list_filter(string_split(s, '/'), lambda p: p <> '' and p <> '.') as parts from (
      select *, trim({expr}) as s from {view}))))))"""


NAMED = f"select *, coalesce(normalized, printf('%06d', index) || '.png') as expected from ({normalized('tasks', 'output_path')})"
PENDING = f"select * from ({NAMED}) where expected not in (select path from outputs)"
PLACED = f"select *, row_number() over (order by index) - 1 as pos, count(*) over () as total from ({PENDING})"


def named(t: Tables):
    return t.tasks().select("index", "lang", "source", "model_type", "_file", "_row",
                            expected_output("index", "output_path").alias("expected"))


def left_over(t: Tables):
    """Pending tasks, stored because positions read them twice."""
    return stored(pending(named(t).select("index", "model_type", "expected", "_file", "_row"), t.outputs()), "left")


# ---- sources -------------------------------------------------------------

@query("a1_read_tasks_parquet",
       "select doc_id as index, lang, n_chars, md5(text) as text_md5, row_number() over (order by doc_id) - 1 as _pos from documents")
def _(t):
    df = read_tasks_parquet(t.spark, t.path("documents"), index="doc_id")
    return df.select("index", "lang", "n_chars", F.md5("text").alias("text_md5"), "_pos")


@query("a1_read_tasks_index_only",
       "select o_orderkey as index, o_orderpriority, row_number() over (order by o_orderkey) - 1 as _pos from orders")
def _(t):
    df = read_tasks_parquet(t.spark, t.path("orders"), True, "o_orderpriority", index="o_orderkey")
    return df.select("index", "o_orderpriority", "_pos")


@query("a8_read_parquet_reindexed",
       "select row_number() over (order by o_orderkey) - 1 as index, o_orderkey, o_custkey from orders")
def _(t):
    return read_parquet_dir_reindexed(t.spark, t.path("orders")).select("index", "o_orderkey", "o_custkey")


def written(t: Tables, label: str, save) -> str:
    """A new place in the shared folder that ``save`` has written to."""
    path = new_path(t.spark, label)
    save(path)
    return path


def _csv(df, path: str) -> None:
    df.write.csv(path, header=True, quote='"', escape='"', emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query("a2_read_tasks_csv", "select doc_id as index, lang, md5(text) as text_md5 from documents")
def _(t):
    # The texts hold quoted line breaks, commas and quotes.
    rows = t.read("documents").select(F.col("doc_id").alias("index"), "lang", "text")
    df = read_tasks(t.spark, written(t, "csv", lambda path: _csv(rows, path)), "csv")
    return df.select("index", "lang", F.md5("text").alias("text_md5"))


@query("a6_read_prompts_csv", "select page_id as index, url as prompt, html as extra from pages")
def _(t):
    rows = t.read("pages").select(F.col("page_id").alias("index"), F.col("url").alias("prompt"), F.col("html").alias("extra"))
    return read_prompts(t.spark, written(t, "csv", lambda path: _csv(rows, path)), "csv").select("index", "prompt", "extra")


_PROMPTS = ["conv_id * 1000 + turn as index", "text as prompt", "role as negative_prompt", "cast(turn as integer) as height"]


@query("a3_read_prompts_jsonl", f"select {', '.join(_PROMPTS)} from conversations")
def _(t):
    rows = t.read("conversations").selectExpr(*_PROMPTS)
    df = read_prompts(t.spark, written(t, "jsonl", rows.write.json), "jsonl")
    return df.select("index", "prompt", "negative_prompt", "height")


@query("a4_read_prompts_json", f"select {', '.join(_PROMPTS)} from conversations")
def _(t):
    # An array per file, of some dozen conversations each.
    rows = t.read("conversations").selectExpr(*_PROMPTS, "conv_id div 50 as part")
    arrays = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct("index", "prompt", "negative_prompt", "height"))).alias("value"))
    path = written(t, "json", lambda path: arrays.write.partitionBy("part").text(path))
    return read_prompts(t.spark, path, "json").select("index", "prompt", "negative_prompt", "height")


@query("a5_read_prompts_txt", """select trim(line) as prompt from (
    select unnest(string_split(text, chr(10))) as line from conversations) where trim(line) <> ''""")
def _(t):
    # A text file has no other row ends than those of the texts.
    path = written(t, "txt", t.read("conversations").select("text").write.text)
    return read_prompts(t.spark, path, "txt").select("prompt")


_FILE = """concat(case page_id % 4 when 0 then '_drafts/' when 1 then '.h/' when 2 then 'x/_' else 'x/y/' end,
    page_id, case page_id % 3 when 0 then ' a.html' else '.html' end)"""


def _named_files(t: Tables) -> str:
    files = t.read("pages").selectExpr(f"{_FILE} as path", "encode(html, 'UTF-8') as data")
    return written(t, "files", lambda path: stored(write_named_blobs(files, path), "manifest"))


@query("a10_list_outputs", f"select {_FILE} as path from pages")
def _(t):
    return list_outputs(t.spark, _named_files(t))


@query("a11_load_image_bytes", f"""select page_id, md5(html) as bytes_md5, null::varchar as error from pages
    union all select page_id + 1000000000, null, 'cannot read' from pages""")
def _(t):
    root = _named_files(t)
    local = root.split("://", 1)[-1].removeprefix("file:")
    refs = t.read("pages").selectExpr("page_id", f"concat('{local}/', {_FILE}) as ref")
    missing = refs.selectExpr("page_id + 1000000000 as page_id", "concat(ref, '.gone') as ref")
    refs = refs.unionByName(missing)
    loaded = load_image_bytes(refs, root)
    return refs.join(loaded, refs["ref"] == loaded["key"]).select(
        "page_id", F.md5("data").alias("bytes_md5"), F.substring("error", 1, 11).alias("error"))


@query("a13_read_worker_logs", sql("log", """select cast(event_id // 1000 % 3 as integer) as node, cast(event_id // 1000 as integer) as file_process,
    cast(event_id % 4 as integer) as process, concat('Saved: ', event_id, '.png') as message, 'saved' as kind from log"""))
def _(t):
    # A thousand lines per file.
    lines = t.log().selectExpr("event_id", "line", "concat('node', event_id div 1000 % 3, '_process', event_id div 1000, '.log') as path")
    files = lines.groupBy("path").agg(F.encode(F.array_join(F.sort_array(F.collect_list("line")), "\n"), "UTF-8").alias("data"))
    folder = written(t, "logs", lambda path: stored(write_named_blobs(files, path), "manifest"))
    return read_worker_logs(t.spark, folder).select("node", "file_process", "process", "message", "kind")


# ---- names ---------------------------------------------------------------

_RAW_INDEX = """case doc_id % 5 when 0 then concat(doc_id, '') when 1 then concat(' ', doc_id, ' ')
    when 2 then concat('x', doc_id) when 3 then null else concat('-', doc_id) end"""


@query("c1_with_index", f"""select try_cast(trim(raw) as bigint) as index, lang from
    (select {_RAW_INDEX} as raw, lang from documents) where try_cast(trim(raw) as bigint) is not null""")
def _(t):
    raw = t.read("documents").selectExpr(f"{_RAW_INDEX} as index", "lang")
    return with_index(raw)


@query("c1_with_index_fallback", f"""select coalesce(try_cast(trim(raw) as bigint), pos) as index, lang from
    (select {_RAW_INDEX} as raw, lang, row_number() over (order by doc_id) - 1 as pos from documents)""")
def _(t):
    df = read_tasks_parquet(t.spark, t.path("documents"), index="doc_id").selectExpr(
        f"{_RAW_INDEX.replace('doc_id', 'index')} as index", "lang", "_pos")
    return with_index(df, fallback="_pos").select("index", "lang")


@query("c2_output_filename", """select conv_id, turn, printf('%06d', conv_id * 7919) || '.png' as single,
    printf('%06d', conv_id * 7919) || '_' || printf('%02d', turn * 30) || '.png' as numbered from conversations""")
def _(t):
    return t.read("conversations").select(
        "conv_id", "turn", output_filename(F.col("conv_id") * 7919).alias("single"),
        output_filename(F.col("conv_id") * 7919, F.col("turn") * 30).alias("numbered"))


@query("c3_normalize_output_path", sql("tasks", f"""
    select a.index, a.normalized as plain, b.normalized as numbered
    from ({normalized('tasks', 'output_path')}) a
    join ({normalized('tasks', 'output_path', "'_03'")}) b on a.index = b.index"""))
def _(t):
    return t.tasks().select("index", normalize_output_path("output_path").alias("plain"),
                            normalize_output_path("output_path", 3).alias("numbered"))


_ODD_NAME = """case page_id % 8 when 0 then concat(' /', url, '/ ') when 1 then concat('//', url, '.PNG')
    when 2 then concat('///', url, '/../x.JPeG') when 3 then concat('./', url, '/.png') when 4 then '././'
    when 5 then concat(url, '...png') when 6 then concat(url, '.jpg.') else url end"""


@query("c3_normalize_odd_paths",
       f"select page_id, normalized from ({normalized(f'(select page_id, {_ODD_NAME} as odd from pages)', 'odd', '''case when page_id % 2 = 0 then '_' || printf('%02d', page_id % 120) else '' end''')})")
def _(t):
    sub = F.when(F.col("page_id") % 2 == 0, F.col("page_id") % 120)
    return t.read("pages").select("page_id", normalize_output_path(F.expr(_ODD_NAME), sub).alias("normalized"))


@query("c4_expected_output", sql("tasks", f"""select a.index, a.expected,
    coalesce(b.normalized, printf('%06d', b.index) || '_00.png') as expected_first
    from ({NAMED}) a join ({normalized('tasks', 'output_path', "'_00'")}) b on a.index = b.index"""))
def _(t):
    return t.tasks().select("index", expected_output("index", "output_path").alias("expected"),
                            expected_output("index", "output_path", n=4).alias("expected_first"))


@query("c5_select_instruction", "select doc_id, md5(text) as chosen, '' as absent from documents")
def _(t):
    df = t.read("documents")
    return df.select("doc_id", F.md5(select_instruction(df, "text")).alias("chosen"),
                     select_instruction(df, "instruction").alias("absent"))


# ---- filters -------------------------------------------------------------

@query("d1_filter_rows", """select o_orderkey, pos as _pos from
    (select o_orderkey, row_number() over (order by o_orderkey) - 1 as pos from orders)
    where pos < 5 or pos = 17 or pos = 9 or (pos >= 100 and pos < 1000) or pos >= 2500""")
def _(t):
    df = read_tasks_parquet(t.spark, t.path("orders"), True, index="o_orderkey")
    return filter_rows(df, ":5, 17,,9,100:1000,2500:").select(F.col("index").alias("o_orderkey"), "_pos")


@query("d2_drop_blank", sql("tasks", "select index, output_path from tasks where output_path is not null and trim(output_path) <> ''"))
def _(t):
    return drop_blank(t.tasks(), "output_path").select("index", "output_path")


@query("d3_lookup_index", """select l_orderkey as index, l_linenumber, l_quantity from lineitem
    where l_orderkey = 7 order by l_linenumber limit 1""")
def _(t):
    df = t.read("lineitem").select(
        F.col("l_orderkey").alias("index"), "l_linenumber", "l_quantity", F.col("l_linenumber").alias("_pos"))
    return lookup_index(df, 7).drop("_pos")


# ---- resume --------------------------------------------------------------

@query("e1_pending", sql("tasks outputs", f"select index, expected, model_type from ({PENDING})"))
def _(t):
    return pending(named(t), t.outputs()).select("index", "expected", "model_type")


@query("e1_pending_without_resume", sql("tasks", f"select index, expected from ({NAMED})"))
def _(t):
    return pending(named(t), t.outputs(), resume=False).select("index", "expected")


@query("e2_completed", sql("tasks outputs", f"select index, expected from ({NAMED}) where expected in (select path from outputs)"))
def _(t):
    return completed(named(t), t.outputs()).select("index", "expected")


@query("e3_load_rows", """select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')""")
def _(t):
    wanted = t.read("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return load_rows(rows, wanted, "l_orderkey")


@query("e4_attach_rows", """select o_orderkey, l_linenumber, l_extendedprice,
    case when l_linenumber is null then concat('Skipping index ', o_orderkey, ': row not found') end as _error
    from orders left join (
        select l_orderkey, l_linenumber, l_extendedprice, row_number() over (
            partition by l_orderkey order by l_linenumber desc, l_extendedprice desc) as k
        from lineitem) r on l_orderkey = o_orderkey and k = 1""")
def _(t):
    rows = t.read("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice",
        F.struct("l_linenumber", "l_extendedprice").alias("_pos"))
    return attach_rows(t.read("orders").select("o_orderkey"), rows, "o_orderkey").drop("_pos")


@query("e9_align_results", sql("tasks", """select index, case when index % 9 = 0 then null when index % 5 = 0 then null
    else md5(instruction) end as image, case when index % 9 = 0 then 'timeout' end as _error from tasks"""))
def _(t):
    # Every reply carries its batch and slot; some failed, some were empty.
    batch = t.tasks().select("index", F.expr("index div 8").alias("_batch"), F.expr("index % 8").alias("_slot"))
    replies = t.tasks().select(
        F.expr("index div 8").alias("_batch"), F.expr("index % 8").alias("_slot"),
        F.expr("case when index % 9 = 0 then 'timeout' end").alias("error"),
        F.expr("case when index % 5 = 0 then array() else array(md5(instruction), 'second') end").alias("images"))
    return align_results(batch, replies)


@query("f1_dataset_stats", sql("tasks outputs", f"""select count(*) as total,
    count(distinct case when done then index end) as completed, count(*) filter (where not done) as pending,
    'documents' as source from (select *, expected in (select path from outputs) as done from ({NAMED}))"""))
def _(t):
    return dataset_stats(named(t), t.outputs(), source="documents")


@query("f12_output_collisions", """select path as expected, count(*) as claims, min(o_orderkey) as first_index from (
    select o_orderkey, concat(o_orderpriority, '/', o_orderkey // 3, '.png') as path from orders)
    group by path having count(*) > 1""")
def _(t):
    names = t.read("orders").select(
        F.col("o_orderkey").alias("index"),
        normalize_output_path(F.expr("concat('./', o_orderpriority, '//', o_orderkey div 3)")).alias("expected"))
    return output_collisions(names)


@query("i1_reconcile_keys", sql("tasks outputs", f"""select coalesce(l.k, r.k) as key,
    case when r.k is null then 'missing' when l.k is null then 'unexpected' else 'matched' end as status
    from (select distinct expected as k from ({NAMED})) l
    full outer join (select distinct path as k from outputs union select concat('extra/', item_id) from benchmark) r on l.k = r.k"""))
def _(t):
    extra = t.read("benchmark").select(F.concat(F.lit("extra/"), "item_id").alias("expected"))
    right = t.outputs().select(F.col("path").alias("expected")).unionAll(extra)
    return reconcile_keys(named(t), right, "expected")


@query("i1_reconcile_counts", sql("tasks outputs", f"""select status, category, count(*) as keys from (
    select coalesce(l.k, r.k) as key, case when r.k is null then 'missing' when l.k is null then 'unexpected' else 'matched' end as status,
      case when contains(lower(coalesce(l.k, r.k)), 'lora') then 'lora' when contains(coalesce(l.k, r.k), 'connector') then 'connector'
        when contains(coalesce(l.k, r.k), 'projector') then 'projector' when contains(coalesce(l.k, r.k), 'meta_queries') then 'meta_queries'
        when starts_with(coalesce(l.k, r.k), 'transformer.') then 'transformer' when starts_with(coalesce(l.k, r.k), 'lmm.') then 'lmm'
        when starts_with(coalesce(l.k, r.k), 'vae.') then 'vae' else 'other' end as category
    from (select concat(case l_linenumber % 4 when 0 then 'transformer.' when 1 then 'lmm.LoRA' when 2 then 'vae.' else 'x_projector_' end, l_partkey) as k
        from lineitem group by all) l
    full outer join (select concat('vae.', p_partkey) as k from part) r on l.k = r.k) group by all"""))
def _(t):
    left = t.read("lineitem").selectExpr("""concat(case l_linenumber % 4 when 0 then 'transformer.' when 1 then 'lmm.LoRA'
        when 2 then 'vae.' else 'x_projector_' end, l_partkey) as key""")
    status = reconcile_keys(left, t.read("part").selectExpr("concat('vae.', p_partkey) as key"), "key")
    return key_categories(status, "key", ("status",))


# ---- positions, shards, batches -------------------------------------------

@query("g1_source_positions", sql("tasks outputs", f"select index, pos as _pos, total as _total from ({PLACED})"))
def _(t):
    return source_positions(left_over(t)).select("index", "_pos", "_total")


@query("g1_positions_by_key", """select l_orderkey, l_linenumber, l_partkey,
    row_number() over (order by l_partkey, l_orderkey, l_linenumber) - 1 as _pos from lineitem""")
def _(t):
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return positions(rows, ["l_partkey", "l_orderkey", "l_linenumber"])


def _sharded(rule):
    def run(t):
        return rule(source_positions(left_over(t)), 3, 4).select("index", "node", "process", "shard_pos", "shard_size")

    return run


query("g2_shard_ceil", sql("tasks outputs", f"""
    select index, node, loc // pc as process, loc % pc as shard_pos, least(pc, size - (loc // pc) * pc) as shard_size from (
      select *, greatest(cast(ceil(size / 4.0) as bigint), 1) as pc from (
        select index, pos // c as node, pos % c as loc, least(c, total - (pos // c) * c) as size from (
          select *, greatest(cast(ceil(total / 3.0) as bigint), 1) as c from ({PLACED}))))"""))(_sharded(shard_ceil))

query("g3_shard_balanced", sql("tasks outputs", f"""
    select index, node, process, row_number() over (partition by node, process order by pos) - 1 as shard_pos,
      count(*) over (partition by node, process) as shard_size from (
      select *, ntile(4) over (partition by node order by pos) - 1 as process from (
        select *, ntile(3) over (order by pos) - 1 as node from ({PLACED})))"""))(_sharded(shard_balanced))

# Batches by plain row numbers inside (node, process, model), models in order.
_BATCHED = f"""select p.*, o.first_batch + p.loc // p.width as batch, o.batches from (
    select *, row_number() over (partition by node, process, model_type order by pos) - 1 as loc,
      case when model_type in ('qwen', 'longcat', 'flux2') then 1 else 8 end as width from (
      select *, ntile(4) over (partition by node order by pos) - 1 as process from (
        select *, ntile(3) over (order by pos) - 1 as node from ({PLACED})))) p
    join (select node, process, model_type,
        cast(coalesce(sum(own) over (partition by node, process order by model_type rows between unbounded preceding and 1 preceding), 0) as bigint)
          as first_batch,
        cast(sum(own) over (partition by node, process) as bigint) as batches from (
      select node, process, model_type, case when model_type in ('qwen', 'longcat', 'flux2') then count(*) else (count(*) + 7) // 8 end as own from (
        select *, ntile(4) over (partition by node order by pos) - 1 as process from (
          select *, ntile(3) over (order by pos) - 1 as node from ({PLACED}))) group by node, process, model_type)) o
    on p.node = o.node and p.process = o.process and p.model_type = o.model_type"""


@query("g4_pack_batches", sql("tasks outputs", f"""select index, node, process, batch, batches,
    concat('batch ', batch + 1, '/', batches) as batch_label from ({_BATCHED})"""))
def _(t):
    sharded = with_capabilities(shard_balanced(source_positions(left_over(t)), 3, 4))
    return pack_batches(sharded, 8, cannot_batch(), ["model_type"]).select(
        "index", "node", "process", "batch", "batches", "batch_label")


@query("g5_pack_shared_image", """select l_orderkey, l_linenumber, image_key,
    row_number() over (partition by image_key order by rank) - 1 as image_pos,
    (row_number() over (partition by image_key order by rank) - 1) // 16 as batch from (
    select l_orderkey, l_linenumber, l_orderkey * 100 + l_linenumber as rank,
      case when l_returnflag = 'N' then 'shared' else concat('img', l_suppkey) end as image_key from lineitem)""")
def _(t):
    # One image is used by about half of all rows.
    rows = t.read("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_orderkey * 100 + l_linenumber as rank",
        "case when l_returnflag = 'N' then 'shared' else concat('img', l_suppkey) end as image_key")
    return pack_shared_image(rows, 16, order="rank").drop("rank")


@query("g10_dedupe_first_last", """select index, min(pos) as first_pos, max(pos) as last_pos,
    arg_min(l_partkey, pos) as first_part, arg_max(l_partkey, pos) as last_part from (
    select l_orderkey as index, l_partkey, l_linenumber * 1000000 + l_partkey as pos from lineitem) group by index""")
def _(t):
    rows = t.read("lineitem").selectExpr(
        "l_orderkey as index", "l_partkey", "l_linenumber * 1000000 + l_partkey as _pos")
    first = dedupe_index(rows, "first").select("index", F.col("_pos").alias("first_pos"), F.col("l_partkey").alias("first_part"))
    last = dedupe_index(rows, "last").select("index", F.col("_pos").alias("last_pos"), F.col("l_partkey").alias("last_part"))
    return first.join(last, "index")


@query("f10_shard_progress", sql("tasks outputs", f"""
    select coalesce(node, -1) as node, coalesce(process, -1) as process, count(*) as total,
      count(*) filter (where done) as completed, count(*) filter (where not done) as pending from (
      select *, expected in (select path from outputs) as done, ntile(4) over (partition by node order by index) - 1 as process from (
        select *, ntile(3) over (order by index) - 1 as node from ({NAMED})))
    group by rollup (node, process)"""))
def _(t):
    sharded = shard_balanced(source_positions(named(t)), 3, 4)
    return shard_progress(with_done(sharded, t.outputs()))


@query("entry_pending_plan", sql("tasks outputs", f"""
    select coalesce(node, -1) as node, coalesce(process, -1) as process, count(*) as total,
      count(distinct case when node is not null then node * 100000000 + process * 1000000 + batch end) as batches, min(index) as first_index
    from ({_BATCHED}) group by rollup (node, process)"""))
def _(t):
    """What is left to do, by node, process and batch."""
    options = PlanOptions(nodes=3, procs=4, batch_size=8, name_col="output_path", model_col="model_type")
    plan = plan_tasks(t.tasks().select("index", "output_path", "model_type", "_file", "_row"), t.outputs(), options)
    rolled = plan.rollup("node", "process").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.col("node") * 100000000 + F.col("process") * 1000000 + F.col("batch")).alias("batches"),
        F.min("index").alias("first_index"))
    return rolled.select(F.coalesce("node", F.lit(-1)).alias("node"), F.coalesce("process", F.lit(-1)).alias("process"),
                         "total", "batches", "first_index")


@query("plan_lineitem", """
    select coalesce(node, -1) as node, coalesce(process, -1) as process, count(*) as total, min(index) as first_index, max(index) as last_index
    from (select *, ntile(4) over (partition by node order by rn) - 1 as process from (
      select *, ntile(16) over (order by rn) - 1 as node from (
        select l_orderkey * 10 + l_linenumber as index, l_orderkey, row_number() over () as rn from lineitem)
      where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')))
    group by rollup (node, process)""")
def _(t):
    """A plan over every line of the largest table; finished orders have all their outputs."""
    tasks = t.read("lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as index",
        "case when l_linenumber % 2 = 0 then concat('./', l_returnflag, '//', l_orderkey, '-', l_linenumber) end as output_path",
        "_metadata.file_path as _file", "_metadata.row_index as _row")
    done = t.read("orders").where("o_orderstatus = 'F'").join(
        t.read("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), F.expr("o_orderkey = l_orderkey"))
    outputs = done.select(F.expr("""case when l_linenumber % 2 = 0 then concat(l_returnflag, '/', l_orderkey, '-', l_linenumber, '.png')
        else format_string('%06d.png', l_orderkey * 10 + l_linenumber) end""").alias("path"))
    plan = plan_tasks(tasks, outputs, PlanOptions(nodes=16, procs=4, batch_size=8, name_col="output_path"))
    rolled = plan.rollup("node", "process").agg(
        F.count(F.lit(1)).alias("total"), F.min("index").alias("first_index"), F.max("index").alias("last_index"))
    return rolled.select(F.coalesce("node", F.lit(-1)).alias("node"), F.coalesce("process", F.lit(-1)).alias("process"),
                         "total", "first_index", "last_index")


@query("plan_strict_samples", sql("tasks outputs", f"""
    select index, cast(sub as integer) as sub, expected, row_number() over (order by index, sub) - 1 as _pos from (
      select t.index, s.sub, coalesce(t.normalized, printf('%06d', t.index)) as stem,
        case when t.normalized is null then printf('%06d', t.index) || '_' || printf('%02d', s.sub) || '.png'
          else t.base || '_' || printf('%02d', s.sub) || t.ext end as expected
      from ({normalized('tasks', 'output_path')}) t, (select unnest(range(0, 3)) as sub) s)
    where expected not in (select regexp_replace(path, '^(.*)([.][a-z]+)$', '\\1_01\\2') from outputs)"""))
def _(t):
    # The second image of every finished document exists, the others do not.
    made = t.outputs().select(F.regexp_replace("path", r"^(.*)([.][a-z]+)$", "$1_01$2").alias("path"))
    options = PlanOptions(n=3, name_col="output_path", strict=True)
    plan = plan_tasks(t.tasks().select("index", "output_path", "_file", "_row"), made, options)
    return plan.select("index", "sub", "expected", "_pos")


@query("h1_in_order", "select doc_id as index, n_chars from documents order by doc_id")
def _(t):
    return t.tasks().select("index", "n_chars").orderBy("index")


@query("j1_expand_samples", """select o_orderkey, cast(case when n > 1 then sub end as integer) as sub from (
    select o_orderkey, greatest(coalesce(n, 1), 1) as n, unnest(range(0, greatest(coalesce(n, 1), 1))) as sub from (
      select o_orderkey, cast(case o_orderkey % 5 when 0 then null when 1 then 0 else o_orderkey % 5 end as bigint) as n from orders))""")
def _(t):
    orders = t.read("orders").selectExpr(
        "o_orderkey", "case o_orderkey % 5 when 0 then null when 1 then 0 else o_orderkey % 5 end as n")
    return expand_samples(orders).drop("n")


# ---- sinks ---------------------------------------------------------------

@query("b1_result_columns", sql("tasks outputs", f"""select cast(t.index as varchar) as index, t.instruction as instruction,
    coalesce(cast(t.steps as varchar), '') as steps, '' as missing, t.expected as output_image
    from ({NAMED}) t where t.expected in (select path from outputs)"""))
def _(t):
    done = completed(t.tasks().withColumn("expected", expected_output("index", "output_path")), t.outputs())
    return result_columns(done.withColumn("output_image", F.col("expected")),
                          ["index", "instruction", "steps", "missing", "output_image"])


@query("b2_merge_results", """
    select doc_id as index, lang, null as role, concat('_node', doc_id % 3, '_process', doc_id % 2) as _shard from documents
    union all select conv_id, null, role, concat('_node', turn) from conversations""")
def _(t):
    documents = t.read("documents").select(
        F.col("doc_id").alias("index"), "lang",
        shard_suffix(F.col("doc_id") % 3, F.col("doc_id") % 2, 3, 2).alias("_shard"))
    talks = t.read("conversations").select(
        F.col("conv_id").alias("index"), "role", shard_suffix(F.col("turn"), F.lit(0), 8, 1).alias("_shard"))
    return merge_results([documents, talks])


@query("b3_write_named_blobs", sql("tasks", f"""select expected as path, cast(octet_length(encode(instruction)) as bigint) as length,
    md5(instruction) as md5, cast(null as varchar) as error from ({NAMED})"""))
def _(t):
    blobs = t.tasks().select(expected_output("index", "output_path").alias("path"), F.encode("instruction", "UTF-8").alias("data"))
    return stored(write_named_blobs(blobs, new_path(t.spark, "blobs").removeprefix("file:")), "manifest")


@query("b6_save_progress", "select 'r1' as run_id, doc_id as index, n_chars from documents")
def _(t):
    # The second save repeats the first, as a retried step would.
    path = new_path(t.spark, "progress")
    rows = t.tasks().select("index", "n_chars")
    save_progress(rows, path, "r1")
    save_progress(rows, path, "r1")
    return read_progress(t.spark, path)


# ---- key categories --------------------------------------------------------

_KEY = """concat(case l_linenumber when 1 then 'transformer.' when 2 then 'lmm.LoRA_' when 3 then 'connector.'
    when 4 then 'vae.' when 5 then 'meta_queries' when 6 then 'projector_' else 'z.vae.' end, l_partkey)"""


@query("f9_key_categories", f"""select case when contains(lower(k), 'lora') then 'lora' when contains(k, 'connector') then 'connector'
    when contains(k, 'projector') then 'projector' when contains(k, 'meta_queries') then 'meta_queries'
    when starts_with(k, 'transformer.') then 'transformer' when starts_with(k, 'lmm.') then 'lmm'
    when starts_with(k, 'vae.') then 'vae' else 'other' end as category, count(distinct k) as keys
    from (select {_KEY} as k from lineitem) group by 1""")
def _(t):
    return key_categories(t.read("lineitem").selectExpr(f"{_KEY} as key"))


@query("f9_key_members", f"""select k, case when contains(lower(k), 'lora') then 'lora' when contains(k, 'connector') then 'connector'
    when contains(k, 'projector') then 'projector' when contains(k, 'meta_queries') then 'meta_queries'
    when starts_with(k, 'transformer.') then 'transformer' when starts_with(k, 'lmm.') then 'lmm'
    when starts_with(k, 'vae.') then 'vae' else 'other' end as category
    from (select distinct {_KEY} as k from lineitem)""")
def _(t):
    return t.read("lineitem").selectExpr(f"{_KEY} as k").distinct().withColumn("category", key_category("k"))
