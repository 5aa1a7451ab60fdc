"""Image references, blobs and fetches."""

from __future__ import annotations

from pyspark.sql import functions as F

from genflow.functions.images import (
    MODEL_REPLY_SCHEMA, classify_image_ref, decode_image_ref, drop_empty_inputs, extract_data_url,
    extract_response_image, image_cache_key, image_header, mime_data_url, parse_input_images, resolve_refs,
    select_input_images,
)
from genflow.operators.images import (
    distinct_refs, explode_images, fetch_images, join_images, keep_loaded, regroup_images, with_ref_key,
)
from genflow.storage import new_path

from .catalog import query, sql

# The references of a page, as SQL lists.
_REFS = """case index % 5 when 0 then [url] when 1 then [url, concat('img/', index, '.png')] when 2 then [url, concat('/abs/', index, '.jpg')]
    when 3 then cast([] as varchar[]) else [concat('rel/', index, '.webp')] end"""
_EXPLODED = f"select index, fetch_ok, html, cast(p - 1 as integer) as ref_pos, refs[p] as ref from (select *, {_REFS} as refs, unnest(range(1, len({_REFS}) + 1)) as p from images)"
# md5 of the URL plus the suffix of its path (query and fragment removed first).
_KEY = """concat(md5(ref), case when contains(string_split(rtrim(split_part(split_part(ref, '?', 1), '#', 1), '/'), '/')[-1], '.')
      and len(string_split(split_part(split_part(ref, '?', 1), '#', 1), '/')) > 3
      then concat('.', string_split(string_split(rtrim(split_part(split_part(ref, '?', 1), '#', 1), '/'), '/')[-1], '.')[-1]) else '.jpg' end)"""
_KEYED = f"select *, case when starts_with(ref, 'http') then {_KEY} else ref end as key from ({_EXPLODED})"


def listed(t):
    return t.images().withColumn("images", parse_input_images("input_images"))


def keyed(t):
    return with_ref_key(explode_images(listed(t), key=("index", "fetch_ok", "html")))


@query("c8_parse_input_images", sql("images", f"select index, len({_REFS}) as n, array_to_string({_REFS}, '|') as images from images"))
def _(t):
    return listed(t).select("index", F.size("images").cast("bigint").alias("n"), F.array_join("images", "|").alias("images"))


@query("c9_resolve_refs", sql("images", f"""select index, string_agg(case when starts_with(ref, 'http') or starts_with(ref, '/') then ref
    else concat('/data/in/', ref) end, '|' order by ref_pos) as refs from ({_EXPLODED}) group by index"""))
def _(t):
    return drop_empty_inputs(listed(t)).select("index", F.array_join(resolve_refs("images", "/data/in/"), "|").alias("refs"))


@query("c10_image_cache_key", f"select page_id, {_KEY} as key from (select page_id, url as ref from pages)")
def _(t):
    return t.read("pages").select("page_id", image_cache_key("url").alias("key"))



@query("c11_image_refs", """select page_id, case page_id % 5 when 0 then 'http' when 1 then 'data' when 4 then 'data' else 'base64' end as kind,
    case when page_id % 5 in (1, 2) then md5(html) end as decoded from pages""")
def _(t):
    ref = F.expr("""case page_id % 5 when 0 then url when 1 then concat('data:image/png;base64,', base64(encode(html, 'UTF-8')))
        when 2 then base64(encode(html, 'UTF-8')) when 3 then 'abc' else 'data:image/png' end""")
    return t.read("pages").select("page_id", classify_image_ref(ref).alias("kind"), F.md5(decode_image_ref(ref)).alias("decoded"))


@query("c12_extract_data_url", """select page_id, case when page_id % 4 in (0, 1) then md5(url) end as image from pages""")
def _(t):
    # The page text around the URL has no data URL of its own.
    text = F.expr("""concat('before ', case page_id % 4 when 0 then concat('DATA:image/JPEG;base64,', base64(encode(url, 'UTF-8')), ')')
        when 1 then concat('data:image/webp;base64,', base64(encode(url, 'UTF-8')), '\\n ! data:image/png;base64,eHg=')
        when 2 then 'data:image/png;base64,abcde' else 'data:image/gif;base64,eHg=' end, html)""")
    return t.read("pages").select("page_id", F.md5(extract_data_url(text)).alias("image"))


_REPLY = """case page_id % 6
    when 0 then to_json(named_struct('candidates', array(named_struct('content', named_struct('parts', array(
        named_struct('text', html, 'inline_data', cast(null as struct<data: string>)),
        named_struct('text', cast(null as string), 'inline_data', named_struct('data', base64(encode(url, 'UTF-8')))))))),
        'parts', array(named_struct('inline_data', named_struct('data', 'eHg=')))))
    when 1 then to_json(named_struct('parts', array(named_struct('inline_data', named_struct('data', base64(encode(html, 'UTF-8')))))))
    when 2 then to_json(named_struct('candidates', array(named_struct('content', named_struct('parts', array(
        named_struct('text', 'no picture'), named_struct('text', concat('see data:image/png;base64,', base64(encode(url, 'UTF-8'))))))))))
    when 3 then '{"candidates": [{"content": null}], "parts": [{"inline_data": {"data": "abcde"}}, {"inline_data": {"data": "eHg="}}]}'
    when 4 then '{}' else to_json(named_struct('parts', array(named_struct('text', html)))) end"""


@query("c13_extract_response_image", """select page_id, case page_id % 6 when 0 then md5(url) when 1 then md5(html) when 2 then md5(url) end as image from pages""")
def _(t):
    rows = t.read("pages").select("page_id", F.from_json(F.expr(_REPLY), MODEL_REPLY_SCHEMA).alias("reply"))
    return rows.select("page_id", F.md5(extract_response_image("reply")).alias("image"))


@query("c27_image_header", sql("tasks", """select index, case when index % 4 < 2 then 'PNG' when index % 4 = 2 then 'JPEG' end as format,
    case when index % 4 < 3 then w end::integer as width, case when index % 4 < 3 then h end::integer as height from tasks"""))
def _(t):
    # Headers of the planned sizes: PNG, JPEG behind a comment segment, and text.
    hex4 = "lpad(hex(w), 4, '0')"
    blob = F.expr(f"""case index % 4
        when 2 then unhex(concat('FFD8FFFE0004AAAAFFC0001108', lpad(hex(h), 4, '0'), {hex4}, '03'))
        when 3 then encode(instruction, 'UTF-8')
        else unhex(concat('89504E470D0A1A0A0000000D49484452', lpad(hex(w), 8, '0'), lpad(hex(h), 8, '0'), '08')) end""")
    return t.tasks().select("index", image_header(blob).alias("p")).select("index", "p.*")


@query("c28_mime_data_url", "select page_id, md5(concat('data:image/png;base64,', to_base64(encode(html)))) as url from pages")
def _(t):
    return t.read("pages").select("page_id", F.md5(mime_data_url(F.encode("html", "UTF-8"))).alias("url"))


@query("c34_select_input_images", sql("images", f"""select index, array_to_string({_REFS}, '|') as all_of, {_REFS}[1] as first_of,
    array_to_string(({_REFS})[1:3], '|') as three_of from images"""))
def _(t):
    return listed(t).select(
        "index", F.array_join(select_input_images("images"), "|").alias("all_of"),
        F.array_join(select_input_images("images", "first"), "|").alias("first_of"),
        F.array_join(select_input_images("images", "first3"), "|").alias("three_of"))


@query("d5_drop_empty_inputs", sql("images", f"select index from images where len({_REFS}) > 0"))
def _(t):
    return drop_empty_inputs(listed(t)).select("index")


@query("j2_explode_images", sql("images", f"select index, ref_pos, ref from ({_EXPLODED})"))
def _(t):
    return explode_images(listed(t))


@query("f11_distinct_refs", sql("images", f"select key, min(ref) as ref from ({_KEYED}) group by key"))
def _(t):
    return distinct_refs(keyed(t))


def _blobs(t):
    """Bytes of the references that could be fetched: here the page the reference is on."""
    rows = keyed(t).where("fetch_ok or ref_pos = 1")
    return rows.groupBy("key").agg(F.min(F.encode("html", "UTF-8")).alias("data"))


_BLOBS = f"select key, min(html) as data from ({_KEYED}) where fetch_ok or ref_pos = 1 group by key"


@query("e8_join_images", sql("images", f"""select k.index, k.ref_pos, k.key, md5(b.data) as data_md5 from ({_KEYED}) k left join ({_BLOBS}) b on k.key = b.key"""))
def _(t):
    # A low threshold, so that the salted path is used for shared images too.
    joined = join_images(keyed(t), _blobs(t), hot_rows=2)
    return joined.select("index", "ref_pos", "key", F.md5("data").alias("data_md5"))


@query("e8_join_hot_image", """select l_orderkey, l_linenumber, image_key as key, p.p_name as data from (
    select l_orderkey, l_linenumber, case when l_returnflag = 'N' then 1 else l_partkey end as image_key from lineitem)
    left join part p on p.p_partkey = image_key""")
def _(t):
    refs = t.read("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "case when l_returnflag = 'N' then 1 else l_partkey end as key")
    blobs = t.read("part").selectExpr("p_partkey as key", "p_name as data")
    return join_images(refs, blobs, row=("l_orderkey", "l_linenumber"), hot_rows=1000)


@query("f2_regroup_images", sql("images", f"""select index, case when bool_and(b.data is not null) then string_agg(md5(b.data), '|' order by ref_pos) end as images,
    case when not bool_and(b.data is not null) then 'failed to load images' end as _error
    from ({_KEYED}) k left join ({_BLOBS}) b on k.key = b.key group by index"""))
def _(t):
    grouped = regroup_images(join_images(keyed(t), _blobs(t)))
    return grouped.select("index", F.array_join(F.transform("images", lambda b: F.md5(b)), "|").alias("images"), "_error")


@query("f2_regroup_embedded", sql("images", f"""select index, coalesce(string_agg(md5(b.data), '|' order by ref_pos), '') as images
    from ({_KEYED}) k left join ({_BLOBS}) b on k.key = b.key group by index"""))
def _(t):
    joined = join_images(keyed(t), _blobs(t))
    packed = joined.groupBy("index").agg(F.sort_array(F.collect_list(F.struct(
        "ref_pos", F.struct(F.col("data").alias("bytes"), F.col("key").alias("path")).alias("item")))).alias("x"))
    packed = packed.withColumn("input_images", F.transform("x", lambda x: x["item"]))
    return packed.select("index", F.array_join(F.transform(keep_loaded(), lambda b: F.md5(b)), "|").alias("images"))


def _stub_fetch(url: str, timeout: int) -> bytes:
    if url.endswith("/"):
        raise OSError("no such page")
    return url.encode()


@query("a12_fetch_images", """select key, case when not ends_with(ref, '/') then md5(ref) end as data_md5,
    case when ends_with(ref, '/') then 'OSError: no such page' end as error from (
      select key, min(ref) as ref from (select """ + _KEY + """ as key, ref from (select url as ref from pages)) group by key)""")
def _(t):
    # The second fetch finds all that worked in the cache.
    refs = t.read("pages").select(F.col("url").alias("ref"))
    cache = new_path(t.spark, "fetched")
    fetch_images(refs, _stub_fetch, cache)
    again = fetch_images(refs, _stub_fetch, cache)
    return again.select("key", F.md5("data").alias("data_md5"), "error")
