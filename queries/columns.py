"""Column functions over whole tables: sizes, prompts, models, log lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from genflow.functions.attempts import RetryPolicy, normalize_base_url, retry_wait
from genflow.functions.logs import error_name, parse_log_line
from genflow.functions.models import (
    EDIT_NAME_PATTERNS, detect_edit_model_type, detect_model_type, inference_kwargs,
    match_patterns, route_edit_backend, route_t2i_backend,
)
from genflow.functions.prompts import (
    build_enhance_request, dominant_language, edit_prompt, final_instruction, generation_prompt,
    parse_enhance_response, recorded_enhancement, single_image_prompt, strip_gen_tags,
)
from genflow.functions.sizes import (
    aspect_ratio, cap_dims, nearest_aspect, nearest_size, parse_size, plan_resize,
)
from genflow.functions.text import preview
from genflow.operators.params import match_pattern_table, resolve_edit_params, resolve_t2i_params, with_capabilities
from genflow.operators.resume import filter_rows

from .catalog import query, sql

# ---- sizes -----------------------------------------------------------------


def _up(x: str) -> str:
    return f"cast(ceil(({x}) / 32.0::double) * 32 as integer)"


@query("c21_resize_fix_pixels", sql("tasks", f"""select index,
    {_up('w::double * (512.0::double / sqrt(h::double * w::double))')} as w,
    {_up('h::double * (512.0::double / sqrt(h::double * w::double))')} as h from tasks"""))
def _(t):
    return t.tasks().select("index", plan_resize("w", "h").alias("s")).select("index", "s.*")


@query("c21_resize_dynamic", sql("tasks", f"""select index,
    case when w >= h and w >= 1024 then 1024 when h >= w and h >= 1024 then {_up('w::double * (1024.0::double / h::double)')} else {_up('w')} end as w,
    case when w >= h and w >= 1024 then {_up('h::double * (1024.0::double / w::double)')} when h >= w and h >= 1024 then 1024 else {_up('h')} end as h
    from tasks"""))
def _(t):
    return t.tasks().select("index", plan_resize("w", "h", "dynamic", 1024).alias("s")).select("index", "s.*")


@query("c21_resize_direct", sql("tasks", "select index, 800 as w, 608 as h from tasks"))
def _(t):
    return t.tasks().select("index", plan_resize("w", "h", "direct", width=777, height=600).alias("s")).select("index", "s.*")


@query("c22_cap_dims", sql("tasks", """select index,
    case when greatest(w, h) > 2000 then cast(trunc(w * (2000.0::double / greatest(w, h)::double)) as integer) else w::integer end as w_2000,
    case when greatest(w, h) > 1024 then cast(trunc(h * (1024.0::double / greatest(w, h)::double)) as integer) // 16 * 16 else h::integer end as h_1024
    from tasks"""))
def _(t):
    return t.tasks().select("index", cap_dims("w", "h")["w"].alias("w_2000"), cap_dims("w", "h", 1024, 16)["h"].alias("h_1024"))


_SIZES = ((256, 256), (512, 512), (1024, 1024), (1792, 1024), (1024, 1792))


@query("c23_nearest_size", sql("tasks", """select index, case when tw is null and th is null then '1024x1024' else
    (select concat(sw, 'x', sh) from (values (0, 256, 256), (1, 512, 512), (2, 1024, 1024), (3, 1792, 1024), (4, 1024, 1792)) s(o, sw, sh)
     order by abs(sw - coalesce(nullif(tw, 0), 1024)) + abs(sh - coalesce(nullif(th, 0), 1024)), o limit 1) end as size
    from (select index, case when index % 10 < 2 then null else w end as tw,
        case when index % 10 = 0 then null when index % 10 = 3 then 0 else h end as th from tasks)"""))
def _(t):
    asked = t.tasks().selectExpr(
        "index", "case when index % 10 < 2 then null else w end as tw",
        "case when index % 10 = 0 then null when index % 10 = 3 then 0 else h end as th")
    return asked.select("index", nearest_size("tw", "th", _SIZES).alias("size"))


@query("c24_nearest_aspect", sql("tasks", """select index,
    (select sw // 16 * 16 from (values (680, 1512), (1024, 1024), (1392, 752), (1328, 808)) s(sw, sh)
     order by abs(w::double / h::double - sw::double / sh::double), sw, sh limit 1) as w,
    (select sh // 16 * 16 from (values (680, 1512), (1024, 1024), (1392, 752), (1328, 808)) s(sw, sh)
     order by abs(w::double / h::double - sw::double / sh::double), sw, sh limit 1) as h from tasks"""))
def _(t):
    listed = ((1024, 1024), (680, 1512), (1328, 808), (1392, 752))
    return t.tasks().select("index", nearest_aspect("w", "h", listed).alias("s")).select("index", "s.*")


@query("c25_aspect_ratio", sql("tasks", """select index, case when w2 > 0 then concat(w2 // gcd(w2, h), ':', h // gcd(w2, h)) end as ratio
    from (select index, case when index % 7 = 0 then 0 else w end as w2, h from tasks)"""))
def _(t):
    return t.tasks().select("index", aspect_ratio(F.when(F.col("index") % 7 == 0, 0).otherwise(F.col("w")), "h").alias("ratio"))


_SIZE_TEXT = """case o_orderkey % 8 when 0 then concat(o_custkey, 'x', o_orderkey) when 1 then concat(' ', o_custkey, ' X ', o_orderkey, ' ')
    when 2 then 'auto' when 3 then '' when 4 then null when 5 then concat(o_custkey, 'x') when 6 then concat(o_custkey, 'x1x', o_orderkey)
    else concat('+', o_custkey, 'X-', o_orderkey) end"""


@query("c26_parse_size", f"""select o_orderkey, case when array_length(p) = 2 then try_cast(trim(p[1]) as integer) + 0 * try_cast(trim(p[2]) as integer) end as w,
    case when array_length(p) = 2 then try_cast(trim(p[2]) as integer) + 0 * try_cast(trim(p[1]) as integer) end as h
    from (select o_orderkey, string_split(lower({_SIZE_TEXT}), 'x') as p from orders)""")
def _(t):
    rows = t.read("orders").selectExpr("o_orderkey", f"{_SIZE_TEXT} as size")
    return rows.select("o_orderkey", parse_size("size").alias("s")).select("o_orderkey", "s.*")


# ---- prompts ---------------------------------------------------------------

@query("c15_dominant_language", """select doc_id, case when length(regexp_replace(v, '[^一-鿿]', '', 'g')) >= len(regexp_extract_all(v, '[a-zA-Z]+')) then 'zh' else 'en' end as language
    from (select doc_id, case doc_id % 4 when 0 then concat(text, repeat('图像', cast(n_chars // 4 as integer))) when 1 then '' else text end as v from documents)""")
def _(t):
    mixed = F.expr("case doc_id % 4 when 0 then concat(text, repeat('图像', cast(n_chars div 4 as int))) when 1 then '' else text end")
    return t.read("documents").select("doc_id", dominant_language(mixed).alias("language"))


_SYSTEM = {"edit": "Rewrite \"edits\".", "zh": "改写", "en": "Rewrite.", "i2i": "With images.", "t2i": "No images."}


def _text_json(prefix: str, suffix: str = "") -> str:
    return f"cast(to_json(concat('{prefix}', instruction, '{suffix}')) as varchar)"


_ZH = "length(regexp_replace(instruction, '[^一-鿿]', '', 'g')) >= len(regexp_extract_all(instruction, '[a-zA-Z]+'))"


@query("c16_request_qwen", sql("tasks", f"""select index, request from (select index, md5(concat(
    '{{"messages":[{{"role":"system","content":"Rewrite \\"edits\\"."}},{{"role":"user","content":[',
    case when index % 3 = 0 then concat('{{"type":"image_url","image_url":{{"url":"data:,', index, '"}}}},') else '' end,
    '{{"type":"text","text":', cast(to_json(concat('User Input: ', instruction, chr(10), chr(10), 'Rewritten Prompt:')) as varchar),
    '}}]}}],"model":"gpt-4o","response_format":{{"type":"json_object"}}}}')) as request from tasks)"""))
def _(t):
    images = F.expr("case when index % 3 = 0 then array(concat('data:,', index)) end")
    return t.tasks().select("index", F.md5(build_enhance_request(
        "instruction", "qwen_image_edit", _SYSTEM, images, "gpt-4o")).alias("request"))


@query("c16_request_glm", sql("tasks", f"""select index, md5(case when {_ZH}
    then concat('{{"messages":[{{"role":"system","content":"改写"}},{{"role":"user","content":[{{"type":"text","text":', {_text_json('用户输入：')}, '}}]}}],"temperature":1.0}}')
    else concat('{{"messages":[{{"role":"system","content":"Rewrite."}},{{"role":"user","content":[{{"type":"text","text":', {_text_json('User input: ')}, '}}]}}],"temperature":1.0}}') end) as request
    from tasks"""))
def _(t):
    return t.tasks().select("index", F.md5(build_enhance_request("instruction", "glm_image", _SYSTEM)).alias("request"))


@query("c16_request_flux2", sql("tasks", f"""select index, md5(concat('{{"messages":[{{"role":"system","content":[{{"type":"text","text":"',
    case when index % 3 = 0 then 'With images.' else 'No images.' end, '"}}]}},{{"role":"user","content":[',
    case when index % 3 = 0 then concat('{{"type":"image_url","image_url":{{"url":"data:,', index, '"}}}},') else '' end,
    '{{"type":"text","text":', {_text_json('')}, '}}]}}],"temperature":0.15,"max_tokens":512}}')) as request from tasks"""))
def _(t):
    images = F.expr("case when index % 3 = 0 then array(concat('data:,', index)) else array() end")
    return t.tasks().select("index", F.md5(build_enhance_request("instruction", "flux2", _SYSTEM, images)).alias("request"))


# Replies made from whole documents: fenced, bare, wrong key, wrong type, not JSON.
_REPLY_SPARK = """case doc_id % 7
    when 0 then concat('```json\\n', to_json(named_struct('Rewritten', text)), '\\n```')
    when 1 then concat('  ', to_json(named_struct('Rewritten', text)), '  ')
    when 2 then to_json(named_struct('Other', text))
    when 3 then '{"Rewritten": 5}' when 4 then text when 5 then '["Rewritten"]'
    else concat('```', to_json(named_struct('Rewritten', text)), '``` and more') end"""


@query("c17_parse_qwen_reply", """select doc_id, md5(case
    when doc_id % 7 in (0, 1) then replace(trim(text, concat(' ', chr(10), chr(9), chr(13))), chr(10), ' ')
    when doc_id % 7 = 2 then replace(source, chr(10), ' ') else source end) as prompt from documents""")
def _(t):
    rows = t.read("documents").selectExpr("doc_id", "source", f"{_REPLY_SPARK} as raw")
    return rows.select("doc_id", F.md5(parse_enhance_response("raw", "source", "qwen_image_edit")).alias("prompt"))


@query("c17_parse_glm_reply", """select doc_id, md5(case when doc_id % 5 = 0 then source
    else trim(text, concat(' ', chr(10), chr(9), chr(13), chr(12288))) end) as prompt from documents""")
def _(t):
    raw = F.expr("case when doc_id % 5 = 0 then null else concat('\\u3000 \\n', text, ' \\t') end")
    return t.read("documents").select("doc_id", F.md5(parse_enhance_response(raw, "source", "glm_image")).alias("prompt"))


@query("c17_parse_flux2_reply", """select doc_id, md5(trim(case doc_id % 4 when 0 then text when 1 then concat('text', chr(10), text)
    when 2 then text else concat(text, chr(10), '```') end, concat(' ', chr(10), chr(9), chr(13)))) as prompt from documents""")
def _(t):
    raw = F.expr("""case doc_id % 4 when 0 then concat('```\\n', text, '\\n``` tail') when 1 then concat('```text\\n', text, '```')
        when 2 then text else concat(' ', text, '\\n```') end""")
    return t.read("documents").select("doc_id", F.md5(parse_enhance_response(raw, "source", "flux2")).alias("prompt"))


@query("c18_strip_gen_tags", """select doc_id, md5(case doc_id % 4
    when 0 then trim(text, concat(' ', chr(10))) when 1 then source when 2 then concat('<gen>', trim(text, concat(' ', chr(10))))
    else trim(text, concat(' ', chr(10))) end) as prompt from documents""")
def _(t):
    raw = F.expr("""case doc_id % 4 when 0 then concat('<gen> ', text, '\\n</gen>') when 1 then '<gen></gen>'
        when 2 then concat('<gen>', text) else text end""")
    return t.read("documents").select("doc_id", F.md5(strip_gen_tags(raw, "source")).alias("prompt"))


@query("c19_final_instruction", """select doc_id, md5(case when doc_id % 3 = 0 then concat('! ', text) else text end) as used,
    case when doc_id % 5 = 0 then concat('because ', source) when doc_id % 3 = 0 then md5(concat('! ', text)) end as recorded from documents""")
def _(t):
    rows = t.read("documents").withColumn("enhanced", F.expr("case when doc_id % 3 = 0 then concat('! ', text) end"))
    reasoning = F.expr("case when doc_id % 5 = 0 then concat('because ', source) else '' end")
    return rows.select("doc_id", F.md5(final_instruction("text", "enhanced")).alias("used"),
                       recorded_enhancement(F.md5("enhanced"), reasoning).alias("recorded"))


@query("c20_render_templates", """select doc_id,
    md5(concat('<|im_start|>user', chr(10), 'Generate an image: ', text, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10))) as generation,
    md5(concat('<|im_start|>user', chr(10), case when doc_id % 3 >= 1 then concat('<|vision_start|>', repeat('<|image_pad|>', 3), '<|vision_end|>') else '' end,
      case when doc_id % 3 = 2 then concat('<|vision_start|>', repeat('<|image_pad|>', cast(doc_id % 11 as integer)), '<|vision_end|>') else '' end,
      chr(10), text, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10))) as edit,
    md5(concat('Edit this image according to the instruction: ', text, chr(10), '[', source, ']')) as single from documents""")
def _(t):
    lens = F.expr("case doc_id % 3 when 0 then array() when 1 then array(3) else array(3, cast(doc_id % 11 as int)) end")
    return t.read("documents").select(
        "doc_id", F.md5(generation_prompt("text")).alias("generation"), F.md5(edit_prompt("text", lens)).alias("edit"),
        F.md5(single_image_prompt("text", F.concat(F.lit("["), "source", F.lit("]")))).alias("single"))


@query("c31_preview", "select doc_id, case when length(text) > 200 then concat(left(text, 200), '...') else text end as shown from documents")
def _(t):
    return t.read("documents").select("doc_id", preview("text", 200).alias("shown"))


# ---- models ----------------------------------------------------------------

_EDIT_TYPES = """(values ('qwen', true, true, false, true, false, 40, 1.0), ('qwen_singleimg', false, false, false, true, false, 50, 1.0),
    ('flux2', true, false, true, false, false, 28, 4.0), ('flux2_klein', true, false, true, false, false, 4, 1.0),
    ('flux1_kontext', false, false, true, false, false, 30, 2.5), ('longcat', false, true, false, false, true, 50, 4.5),
    ('glm_image', true, true, false, false, false, 50, 1.5)) c(mt, multi, no_batch, shared, tcfg, neg, st, gd)"""


@query("e5_with_capabilities", sql("tasks", f"""select index, model_type, coalesce(multi, false) as multi_image,
    coalesce(no_batch, false) as batch_disabled, coalesce(shared, false) as shared_image_batch, coalesce(tcfg, false) as use_true_cfg,
    coalesce(neg, false) as use_negative_prompt, coalesce(st, 28) as default_steps, cast(coalesce(gd, 3.5) as double) as default_guidance
    from tasks left join {_EDIT_TYPES} on model_type = mt"""))
def _(t):
    return with_capabilities(t.tasks()).select(
        "index", "model_type", "multi_image", "batch_disabled", "shared_image_batch", "use_true_cfg", "use_negative_prompt",
        "default_steps", "default_guidance")


@query("c6_edit_params", sql("tasks", f"""select index, cast(coalesce(nullif(steps, 0), st, 28) as integer) as num_inference_steps,
    cast(coalesce(nullif(index % 3, 0), gd, 3.5) as double) as guidance_scale,
    cast(case when coalesce(tcfg, false) then 4.0 end as double) as true_cfg_scale,
    case when coalesce(neg, false) and index % 2 = 1 then 'blurry' end as negative_prompt
    from tasks left join {_EDIT_TYPES} on model_type = mt"""))
def _(t):
    rows = t.tasks().withColumn("guidance", F.col("index") % 3).withColumn(
        "negative", F.when(F.col("index") % 2 == 1, "blurry").otherwise(""))
    return resolve_edit_params(rows, steps="steps", guidance="guidance", negative="negative").select(
        "index", "num_inference_steps", "guidance_scale", "true_cfg_scale", "negative_prompt")


@query("c6_t2i_params", sql("tasks", """select index, cast(coalesce(steps, st, 28) as integer) as num_inference_steps,
    cast(coalesce(gd, 3.5) as double) as guidance_scale from (select *, case index % 8 when 0 then 'flux' when 1 then 'sd3' when 2 then 'sdxl' when 3 then 'sd'
      when 4 then 'hunyuan' when 5 then 'pixart' when 6 then 'cogview' else 'other' end as kind from tasks)
    left join (values ('flux', 28, 3.5), ('sd3', 28, 7.0), ('sdxl', 30, 7.5), ('sd', 50, 7.5), ('hunyuan', 50, 5.0), ('pixart', 20, 4.5),
      ('cogview', 50, 7.5)) c(mt, st, gd) on kind = mt"""))
def _(t):
    kinds = F.expr("""case index % 8 when 0 then 'flux' when 1 then 'sd3' when 2 then 'sdxl' when 3 then 'sd'
        when 4 then 'hunyuan' when 5 then 'pixart' when 6 then 'cogview' else 'other' end""")
    return resolve_t2i_params(t.tasks().withColumn("kind", kinds), model_type="kind", steps="steps").select(
        "index", "num_inference_steps", "guidance_scale")


_MODEL_NAME = """case p_partkey % 12 when 0 then concat('black-forest-labs/FLUX.2-dev', p_brand) when 1 then 'Qwen/Qwen-Image-Edit'
    when 2 then concat('Qwen/qwen-image-edit-', p_partkey) when 3 then 'x/qwen-image-edit_v2' when 4 then concat('x/qwen-image-editor/', p_brand)
    when 5 then 'stabilityai/stable-diffusion-3-medium' when 6 then concat('other/', p_name) when 7 then 'stabilityai/Stable-Diffusion-XL-base'
    when 8 then concat('meituan/LongCat-', p_type) when 9 then 'a/qwen-image-editX/qwen-image-edit' when 10 then 'Zhipu/GLM-image'
    else concat('PixArt/', p_brand) end"""


@query("c29_detect_model_type", f"""select p_partkey, case
    when contains(n, 'flux') then 'flux' when contains(n, 'stable-diffusion-3') then 'sd3' when contains(n, 'stable-diffusion-xl') then 'sdxl'
    when contains(n, 'stable-diffusion') then 'sd' when contains(n, 'hunyuandit') then 'hunyuan' when contains(n, 'pixart') then 'pixart'
    when contains(n, 'cogview') then 'cogview' when contains(n, 'qwen-image-edit-plus') or contains(n, 'qwen-image-edit-2509') or contains(n, 'qwen-image-edit-2511') then 'qwen'
    when contains(n, 'qwen-image-edit') then 'qwen_singleimg' when contains(n, 'longcat') then 'longcat' when contains(n, 'glm-image') then 'glm_image' end as model_type
    from (select p_partkey, lower({_MODEL_NAME}) as n from part)""")
def _(t):
    return t.read("part").select("p_partkey", detect_model_type(F.expr(_MODEL_NAME)).alias("model_type"))


@query("c29_detect_edit_model_type", f"""select p_partkey, case p_partkey % 12 when 0 then 'flux2' when 1 then 'qwen_singleimg' when 2 then 'qwen'
    when 3 then 'qwen_singleimg' when 8 then 'longcat' when 9 then 'qwen_singleimg' when 10 then 'glm_image' else null end as model_type from part""")
def _(t):
    return t.read("part").select("p_partkey", detect_edit_model_type(F.expr(_MODEL_NAME)).alias("model_type"))


@query("e6_match_patterns", f"""select p_partkey, case when contains(n, 'flux.2-dev') then 'flux2' when contains(n, 'flux.2-klein') then 'flux2_klein'
    when contains(n, 'flux.1-kontext') then 'flux1_kontext' when contains(n, 'longcat') then 'longcat' when contains(n, 'glm-image') then 'glm_image' end as matched
    from (select p_partkey, lower({_MODEL_NAME}) as n from part)""")
def _(t):
    return t.read("part").select("p_partkey", match_patterns(F.expr(_MODEL_NAME), EDIT_NAME_PATTERNS).alias("matched"))


# Numbers of customers, then pieces of part types, as patterns: as many as there are customers and parts.
_CUSTOMER_PATTERNS = ["c_custkey as ordinal", "substring(c_name, 14, 5) as pattern", "concat('c', c_custkey) as value"]
_PART_PATTERNS = ["1000000 + p_partkey as ordinal",
                  "case p_partkey % 100 when 7 then '' when 8 then null when 9 then '#' else upper(substring(p_type, 3 + p_partkey % 3, 9)) end as pattern",
                  "concat('t', p_partkey) as value"]
_NUMBERED_NAME = "concat(p_type, ' #', lpad(concat(p_partkey * 3, ''), 6, '0')) as name"


@query("e6_pattern_table", f"""with patterns as (select {', '.join(_CUSTOMER_PATTERNS)} from customer union all select {', '.join(_PART_PATTERNS)} from part),
    names as (select p_partkey, {_NUMBERED_NAME} from part)
    select p_partkey, arg_min(value, ordinal) as matched from names left join patterns on contains(lower(name), lower(pattern)) group by p_partkey""")
def _(t):
    patterns = t.read("customer").selectExpr(*_CUSTOMER_PATTERNS).unionByName(t.read("part").selectExpr(*_PART_PATTERNS))
    return match_pattern_table(t.read("part").selectExpr("p_partkey", _NUMBERED_NAME), patterns).select("p_partkey", "matched")


@query("c6_t2i_row_values", sql("tasks", """select index, coalesce(case when index % 3 > 0 then cast(w as integer) end, 640) as width,
    case when index % 2 = 0 then cast(h as integer) end as height, case when trim(output_path) <> '' then output_path else 'blurry' end as negative_prompt from tasks"""))
def _(t):
    rows = t.tasks().selectExpr("index", "model_type", "case when index % 3 > 0 then w end as width", "case when index % 2 = 0 then h end as height",
                                "output_path as negative_prompt")
    return resolve_t2i_params(rows, job={"width": 640, "negative_prompt": "blurry"}).select("index", "width", "height", "negative_prompt")


@query("d1_many_ranges", sql("tasks", """select index from tasks where index % 7 < 3 and index < 100000 or index >= 100000"""))
def _(t):
    ranges = ",".join(f"{k}:{k + 3}" for k in range(0, 100_000, 7)) + ",100000:"
    return filter_rows(t.tasks().withColumn("_pos", F.col("index")), ranges).select("index")


_BACKEND = """case l_linenumber % 7 when 0 then 'Diffusers' when 1 then 'openai' when 2 then 'gemini' when 3 then 'google_genai'
    when 4 then 'bagel' when 5 then 'mine' else 'nothing' end"""
_BACKEND_TYPE = """case l_partkey % 5 when 0 then 'qwen' when 1 then 'step1x' when 2 then 'odd' else null end"""


@query("c30_route_edit_backend", f"""select l_orderkey, l_linenumber, route, case when route is null then concat('unknown backend: ', b) end as error from (
    select *, case when b = 'diffusers' or m = 'qwen' then 'diffusers' when b = 'openai' then 'openai' when b in ('gemini', 'google_genai') then 'google_genai'
      when m = 'step1x' then 'step1x' when b = 'bagel' and m is null then 'bagel' when b = 'mine' then 'mine' end as route
    from (select l_orderkey, l_linenumber, lower({_BACKEND}) as b, {_BACKEND_TYPE} as m from lineitem))""")
def _(t):
    rows = t.read("lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_BACKEND} as b", f"{_BACKEND_TYPE} as m")
    return rows.select("l_orderkey", "l_linenumber", route_edit_backend("b", "m", ["mine"]).alias("r")).select(
        "l_orderkey", "l_linenumber", "r.*")


@query("c30_route_t2i_backend", f"""select l_orderkey, l_linenumber, case when b in ('diffusers', 'openai') then b when b in ('gemini', 'google_genai') then 'google_genai' end as route
    from (select l_orderkey, l_linenumber, lower({_BACKEND}) as b from lineitem)""")
def _(t):
    rows = t.read("lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_BACKEND} as b")
    return rows.select("l_orderkey", "l_linenumber", route_t2i_backend("b")["route"].alias("route"))


@query("c33_inference_kwargs", sql("tasks", """select index, concat('height=', h, ';steps=30', case when index % 3 = 0 then ';quality=high' else '' end,
    case when index % 2 = 0 then concat(';width=', w) else '' end) as arguments from tasks"""))
def _(t):
    width, quality = F.expr("case when index % 2 = 0 then w end"), F.expr("case when index % 3 = 0 then 'high' end")
    given = inference_kwargs(width, "h", quality, steps=30)
    items = F.transform(F.sort_array(F.map_entries(given)), lambda e: F.concat_ws(
        "=", F.replace(e["key"], F.lit("num_inference_steps"), F.lit("steps")), e["value"]))
    return t.tasks().select("index", F.array_join(items, ";").alias("arguments"))


# ---- endpoints and logs ------------------------------------------------------

_URL = """case page_id % 8 when 0 then concat(url, '/v1beta/') when 1 then concat(' ', url, '/v1// ') when 2 then concat(url, '///')
    when 3 then '' when 4 then null when 5 then concat(url, '/v1alpha') when 6 then '  ' else concat(url, '/v1/v1') end"""


@query("c14_normalize_base_url", f"""select page_id, case when raw is null or raw = '' then null else left(t, length(t) - length(suffix)) end as url,
    case when page_id % 3 = 0 then 'v9' when raw is null or raw = '' then null when suffix <> '' then substr(suffix, 2) end as version from (
    select *, case when ends_with(t, '/v1beta') then '/v1beta' when ends_with(t, '/v1alpha') then '/v1alpha' when ends_with(t, '/v1') then '/v1' else '' end as suffix
    from (select page_id, {_URL} as raw, rtrim(trim({_URL}), '/') as t from pages))""")
def _(t):
    version = F.expr("case when page_id % 3 = 0 then 'v9' end")
    return t.read("pages").select("page_id", normalize_base_url(F.expr(_URL), version).alias("u")).select("page_id", "u.*")


_LINE = """case event_id % 6 when 0 then line when 1 then concat('2024-01-02 03:04:05 - [Rank 1] - w.x - ERROR - [E2002] slow call for ', task)
    when 2 then concat('2024-01-02 03:04:06 - [Rank 2] - w - INFO - [Process 3] Processing batch ', task, '/900...')
    when 3 then concat('2024-01-02 03:04:07 - [Rank 0] - w - INFO - [Process 0] Completed: ', task, ' successful, 2 failed')
    when 4 then concat('  File "x.py", line ', task) else concat('2024-01-02 03:04:08 - [Rank 0] - w - INFO - [Process 1] Skipping index ', task, ': row not found') end"""


@query("c32_parse_log_line", sql("log", """select event_id,
    case event_id % 6 when 0 then 'saved' when 1 then 'other' when 2 then 'batch' when 3 then 'completed' when 5 then 'skipping' end as kind,
    case event_id % 6 when 0 then 1704067200000000 when 4 then null else 1704164645000000 + (case event_id % 6 when 1 then 0 when 2 then 1 when 3 then 2 else 3 end) * 1000000 end as ts_us,
    cast(case event_id % 6 when 0 then event_id % 4 when 1 then 1 when 2 then 2 when 4 then null else 0 end as integer) as rank,
    cast(case event_id % 6 when 0 then event_id % 4 when 2 then 3 when 3 then 0 when 5 then 1 end as integer) as process,
    case event_id % 6 when 1 then 'ERROR' when 4 then null else 'INFO' end as level,
    case when event_id % 6 = 0 then concat(event_id, '.png') end as path,
    cast(case when event_id % 6 = 2 then task end as integer) as batch, cast(case when event_id % 6 = 2 then 900 end as integer) as batches,
    cast(case when event_id % 6 = 3 then task end as integer) as successful, cast(case when event_id % 6 = 3 then 2 end as integer) as failed,
    case when event_id % 6 = 1 then 'E2002' end as code, case when event_id % 6 = 4 then concat('  File "x.py", line ', task) end as raw from log"""))
def _(t):
    parsed = t.log().select("event_id", parse_log_line(F.expr(_LINE)).alias("p"))
    return parsed.select("event_id", "p.kind", F.unix_micros("p.ts").alias("ts_us"), "p.rank", "p.process", "p.level", "p.path",
                         "p.batch", "p.batches", "p.successful", "p.failed", "p.code", "p.raw")


@query("f5_error_names", sql("log", """select event_id, case code when 'E2001' then 'API_CONNECTION_ERROR' when 'E2002' then 'API_TIMEOUT_ERROR'
    when 'E1004' then 'EDITING_ERROR' end as name from log"""))
def _(t):
    return t.log().select("event_id", error_name("code").alias("name"))


@query("j3_retry_wait", sql("log", """select event_id, cast(case when task % 9 < 8 then least(1.0::double * pow(2.0::double, task % 9), 60.0::double) else 0 end as double) as wait from log"""))
def _(t):
    return t.log().select("event_id", retry_wait(F.col("task") % 9, RetryPolicy(retries=8)).alias("wait"))
