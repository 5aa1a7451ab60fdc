"""Request records: parsing, checks, outputs, responses, endpoint settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from genflow.operators.requests import build_image_responses, checked_requests, collect_outputs, validate_requests
from genflow.operators.shards import expand_samples
from genflow.sources.endpoints import explode_endpoints
from genflow.sources.requests import parse_request

from .catalog import query, sql

_NUMBER = "try_cast(json_extract_string(body, '$.n') as integer)"


def parsed(t):
    return t.requests().withColumn("request", parse_request("body"))


@query("a14_parse_requests", sql("requests", f"""select request_id, json_extract_string(body, '$.prompt') as prompt, coalesce({_NUMBER}, 1) as n,
    json_extract_string(body, '$.size') as size, 'png' as output_format, 'b64_json' as response_format,
    json_extract_string(body, '$.images[0].image_url') as image_url, json_extract_string(body, '$.images[0].file_id') as file_id from requests"""))
def _(t):
    r = parsed(t)
    return r.select("request_id", "request.prompt", "request.n", "request.size", "request.output_format", "request.response_format",
                    F.col("request.images")[0]["image_url"].alias("image_url"), F.col("request.images")[0]["file_id"].alias("file_id"))


# Bodies of every kind: the given ones, cut ones, and edits with mixed references.
_BODY = """case request_id % 7 when 0 then substr(body, 1, length(body) - 1)
    when 1 then concat('{"prompt": "q', conv_id, '", "n": null, "output_format": "JPEG", "images": [{}, {"image_url": "abc"}, {"file_id": "z"}]}')
    when 2 then concat('{"prompt": "q', conv_id, '", "images": [], "size": "10x20"}')
    when 3 then concat('{"prompt": "q', conv_id, '", "images": [{"image_url": "http://x/', conv_id, '"}], "mask": {"image_url": "abc"}}')
    else body end"""


def _check_oracle(mode: str | None) -> str:
    mode_rule = "" if mode is None else f"when kind <> '{mode}' then 400"
    edit_mode = "" if mode is None else f"when kind = 'edit' and kind <> '{mode}' then 400"
    return sql("requests", f"""select request_id, cast(case {edit_mode}
        when not json_valid(b) then 422
        when json_extract_string(b, '$.prompt') is null or (kind = 'edit' and json_extract_string(b, '$.prompt') = '') then 422
        {mode_rule}
        when kind = 'edit' and contains(b, '"image_url": "abc"') then 400
        when kind = 'edit' and contains(b, '"file_id"') then 400
        when kind = 'edit' and not contains(b, '"image_url"') then 422
        else 200 end as integer) as status,
        greatest(coalesce(case when json_valid(b) then try_cast(json_extract_string(b, '$.n') as integer) end, 1), 1) as n,
        case when contains(b, 'JPEG') then 'jpeg' else 'png' end as format,
        cast(case when not json_valid(b) then null when contains(b, '1024X768') then 1024 when contains(b, '10x20') then 10 end as integer) as width
        from (select request_id, conv_id, kind, {_BODY} as b from requests)""")


def _checked(mode):
    def run(t):
        rows = t.requests().withColumn("request", parse_request(F.expr(_BODY)))
        return checked_requests(rows, mode=mode).select(
            "request_id", F.col("_status").alias("status"), F.col("_n").alias("n"), F.col("_format").alias("format"),
            F.col("_width").alias("width"))

    return run


query("d4_validate_requests", _check_oracle(None))(_checked(None))
query("d4_validate_t2i_server", _check_oracle("t2i"))(_checked("t2i"))
query("d4_validate_edit_server", _check_oracle("edit"))(_checked("edit"))


@query("d4_rejected_details", sql("requests", """select request_id, case turn % 5 when 4 then 400 end as status,
    'file_id references are not supported. Use image_url instead.' as detail from requests where turn % 5 = 4"""))
def _(t):
    rejected = validate_requests(parsed(t))[1]
    return rejected.select("request_id", F.col("_status").alias("status"), F.col("_detail").alias("detail"))


_CALLS = """select request_id, sub, md5(concat(request_id, '-', sub)) as image from (
    select request_id, unnest(range(0, case turn % 5 when 0 then 3 else 1 end)) as sub from requests where turn % 5 <> 4)"""


@query("j1_expand_requests", sql("requests", """select request_id, cast(case when turn % 5 = 0 then sub end as integer) as sub from (
    select request_id, turn, unnest(range(0, case turn % 5 when 0 then 3 else 1 end)) as sub from requests where turn % 5 <> 4)"""))
def _(t):
    return expand_samples(validate_requests(parsed(t))[0], "_n").select("request_id", "sub")


@query("f7_collect_outputs", sql("requests", f"""select request_id, count(*) as n, string_agg(image, '|' order by sub) as images from ({_CALLS}) group by request_id"""))
def _(t):
    calls = expand_samples(validate_requests(parsed(t))[0], "_n")
    image = F.md5(F.concat_ws("-", "request_id", F.coalesce("sub", F.lit(0))))
    outputs = collect_outputs(calls.select("request_id", "sub", F.array(image).alias("images")))
    return outputs.select("request_id", F.size("images").cast("bigint").alias("n"), F.array_join("images", "|").alias("images"))


@query("b4_image_responses", """select conv_id, md5(concat('{"created":', 1700000000 + conv_id, ',"data":[',
    string_agg(concat('{"b64_json":"', to_base64(encode(text)), '"}'), ',' order by turn), '],"output_format":"png"}')) as response
    from conversations group by conv_id""")
def _(t):
    # The images of a response stand in for the turns of a conversation.
    calls = t.read("conversations").select(
        F.col("conv_id").alias("request_id"), F.col("turn").alias("sub"), F.array(F.encode("text", "UTF-8")).alias("images"))
    outputs = collect_outputs(calls).withColumn("_format", F.lit("png"))
    done = build_image_responses(outputs, F.col("request_id") + 1_700_000_000)
    return done.select(F.col("request_id").alias("conv_id"), F.md5("response").alias("response"))


_SETTINGS = [
    "c_custkey",
    """case c_custkey % 4 when 0 then '' when 1 then concat('http://a', c_custkey, ', ,http://c') when 2 then null
        else concat(' http://only', c_custkey, ' ') end as urls""",
    "case c_custkey % 3 when 0 then 'k1, k2,,k3' when 1 then 'k1' else null end as keys",
    "case c_custkey % 5 when 0 then '60,30' when 1 then null else concat(c_custkey, '') end as rates",
    "case c_custkey % 2 when 0 then concat(' ', 1 + c_custkey % 9, ' ') else '' end as weights",
]


@query("a15_endpoints", f"""select c_custkey, cast(p - 1 as integer) as endpoint, nullif(trim(u[p]), '') as base_url,
    coalesce(case when c_custkey % 5 = 0 then [60, 30][p] when c_custkey % 5 = 1 then null when p = 1 then c_custkey end, 0)::integer as rate_limit,
    (case when c_custkey % 2 = 0 and p = 1 then 1 + c_custkey % 9 else 1 end)::integer as weight,
    (case c_custkey % 3 when 0 then 3 when 1 then 1 else 0 end)::integer as n_keys from (
      select *, unnest(range(1, len(u) + 1)) as p from (
        select *, string_split(coalesce(urls, ''), ',') as u from (select {', '.join(_SETTINGS)} from customer)
        where coalesce(urls, '') <> '' or coalesce(keys, '') <> ''))""")
def _(t):
    return explode_endpoints(t.read("customer").selectExpr(*_SETTINGS))
