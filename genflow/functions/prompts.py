"""Prompt rewriting requests and replies, templates and language choice."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import col_of, strict_json, strip

STYLES = ("qwen_image_edit", "glm_image", "flux2")

# Request wording and parameters the rewriting services expect.
QWEN_USER_TEXT = "User Input: {prompt}\n\nRewritten Prompt:"
GLM_USER_TEXT_ZH = "用户输入：{prompt}"
GLM_USER_TEXT_EN = "User input: {prompt}"
GLM_TEMPERATURE = 1.0
FLUX2_TEMPERATURE = 0.15
FLUX2_MAX_TOKENS = 512
JSON_REPLY_MODELS = ("gpt", "qwen")

# Chat wrapper, image tokens and edit wording of the prompt templates.
GENERATION_TEMPLATE = "Generate an image: {input}"
INSTRUCTION_TEMPLATE = "<|im_start|>user\n{input}<|im_end|>\n<|im_start|>assistant\n"
IMG_START_TOKEN = "<|vision_start|>"
IMG_CONTEXT_TOKEN = "<|image_pad|>"
IMG_END_TOKEN = "<|vision_end|>"
EDIT_TEMPLATE = "Edit this image according to the instruction: {question}\n<|IMAGE|>"
GEN_OPEN, GEN_CLOSE = "<gen>", "</gen>"


def dominant_language(text) -> Column:
    """'zh' when CJK characters are at least as many as Latin words, else 'en'."""
    text = F.coalesce(col_of(text), F.lit(""))
    cjk = F.length(F.regexp_replace(text, "[^\\u4e00-\\u9fff]", ""))
    words = F.regexp_count(text, F.lit("[a-zA-Z]+"))
    return F.when(cjk >= words, F.lit("zh")).otherwise(F.lit("en"))


def render_template(template: str, **values) -> Column:
    """Fill ``{name}`` placeholders with columns or constants."""
    pieces = re.split(r"\{(\w+)\}", template)
    out = []
    for i, piece in enumerate(pieces):
        if i % 2:
            v = values[piece]
            out.append(v if isinstance(v, Column) else F.lit(v))
        elif piece:
            out.append(F.lit(piece))
    return F.concat(*out) if out else F.lit("")


def generation_prompt(text) -> Column:
    return render_template(INSTRUCTION_TEMPLATE, input=render_template(GENERATION_TEMPLATE, input=col_of(text)))


def edit_prompt(text, ref_lens) -> Column:
    """Image tokens (one padded run per reference), a newline, then the text, in the chat wrapper."""
    runs = F.transform(col_of(ref_lens), lambda n: F.concat(
        F.lit(IMG_START_TOKEN), F.repeat(F.lit(IMG_CONTEXT_TOKEN), n.cast("int")), F.lit(IMG_END_TOKEN)))
    body = F.concat(F.array_join(runs, ""), F.lit("\n"), col_of(text))
    return render_template(INSTRUCTION_TEMPLATE, input=body)


def single_image_prompt(text, image) -> Column:
    """Edit template with the image placeholder replaced, also where the text names it."""
    asked = render_template(EDIT_TEMPLATE, question=col_of(text))
    return F.replace(asked, F.lit("<|IMAGE|>"), col_of(image))


def _text_part(text: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), text.alias("text"))


def _user_content(images: Column, text: Column) -> Column:
    part = "STRUCT<type: STRING, text: STRING, image_url: STRUCT<url: STRING>>"
    pictures = F.transform(images, lambda u: F.struct(
        F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
        F.struct(u.alias("url")).alias("image_url")).cast(part))
    words = F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"),
        F.lit(None).cast("STRUCT<url: STRING>").alias("image_url")).cast(part))
    return F.concat(pictures, words)


def build_enhance_request(prompt, style: str, system: dict[str, str], images=None, model: str = "") -> Column:
    """JSON chat request asking a service to rewrite ``prompt``.

    ``system`` holds the caller's instructions: key 'edit' for qwen_image_edit,
    'zh' and 'en' for glm_image, 'i2i' and 't2i' for flux2. ``images`` is an
    array of data URLs. Fields without a value are left out.
    """
    prompt = F.coalesce(col_of(prompt), F.lit(""))
    no_images = F.array().cast("array<string>")
    images = no_images if images is None else F.coalesce(col_of(images), no_images)
    options = {}
    if style == "qwen_image_edit":
        system_message = F.struct(F.lit("system").alias("role"), F.lit(system["edit"]).alias("content"))
        user = _user_content(images, render_template(QWEN_USER_TEXT, prompt=prompt))
        if any(m in model.lower() for m in JSON_REPLY_MODELS):
            options["response_format"] = F.struct(F.lit("json_object").alias("type"))
    elif style == "glm_image":
        chinese = dominant_language(prompt) == "zh"
        system_message = F.struct(
            F.lit("system").alias("role"),
            F.when(chinese, F.lit(system["zh"])).otherwise(F.lit(system["en"])).alias("content"))
        user = _user_content(no_images, F.when(chinese, render_template(GLM_USER_TEXT_ZH, prompt=prompt)).otherwise(
            render_template(GLM_USER_TEXT_EN, prompt=prompt)))
        options["temperature"] = F.lit(GLM_TEMPERATURE)
    elif style == "flux2":
        chosen = F.when(F.size(images) > 0, F.lit(system["i2i"])).otherwise(F.lit(system["t2i"]))
        system_message = F.struct(
            F.lit("system").alias("role"), F.array(_text_part(chosen)).alias("content"))
        user = _user_content(images, prompt)
        options["temperature"] = F.lit(FLUX2_TEMPERATURE)
        options["max_tokens"] = F.lit(FLUX2_MAX_TOKENS)
    else:
        raise ValueError(f"unknown style {style!r}; use one of {', '.join(STYLES)}")
    user_message = F.struct(F.lit("user").alias("role"), user.alias("content"))
    # The system content is text in two styles and a list in the third, so the
    # two messages cannot share one array type and are joined as JSON.
    parts = [F.lit('{"messages":['), F.to_json(system_message), F.lit(","), F.to_json(user_message), F.lit("]")]
    head = {"model": F.lit(model)} if model else {}
    for key, value in {**head, **options}.items():
        json_value = F.to_json(F.struct(value.alias("v")))
        parts += [F.lit(f',"{key}":'), F.substring(json_value, F.lit(6), F.length(json_value) - 6)]
    return F.concat(*parts, F.lit("}"))


_FENCE = "```"


def _after(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def reply_json(raw) -> Column:
    """The JSON text of a qwen-style reply, without code fences."""
    text = _after(_after(strip(raw), _FENCE + "json"), _FENCE)
    cut = F.when(text.endswith(_FENCE), F.substring(text, F.lit(1), F.length(text) - 3)).otherwise(text)
    return strip(cut)


def parse_enhance_response(raw, original, style: str) -> Column:
    """Rewritten prompt from a service reply; any failure gives the original prompt."""
    raw, original = col_of(raw), col_of(original)
    if style == "qwen_image_edit":
        value = strict_json(reply_json(raw))
        is_object = F.schema_of_variant(value).startswith("OBJECT")
        field = F.try_variant_get(value, "$.Rewritten", "variant")
        text = F.when(field.isNull(), original).when(
            F.schema_of_variant(field) == "STRING", F.try_variant_get(value, "$.Rewritten", "string"))
        found = F.when(is_object, F.replace(strip(text), F.lit("\n"), F.lit(" ")))
    elif style == "glm_image":
        found = strip(raw)
    elif style == "flux2":
        text = strip(raw)
        inner = F.try_element_at(F.split(text, _FENCE), F.lit(2))
        found = strip(F.when(text.startswith(_FENCE), _after(inner, "\n")).otherwise(text))
    else:
        raise ValueError(f"unknown style {style!r}; use one of {', '.join(STYLES)}")
    return F.coalesce(found, original)


def strip_gen_tags(text, original) -> Column:
    """Text between matching <gen> tags (or the whole text); the original when empty."""
    text, original = col_of(text), col_of(original)
    tagged = text.startswith(GEN_OPEN) & text.endswith(GEN_CLOSE)
    inner = F.substring(text, F.lit(len(GEN_OPEN) + 1), F.length(text) - len(GEN_OPEN) - len(GEN_CLOSE))
    body = strip(F.when(tagged, inner).otherwise(text))
    return F.coalesce(F.nullif(body, F.lit("")), original)


def final_instruction(instruction, enhanced=None) -> Column:
    """The instruction sent to the model."""
    return F.coalesce(col_of(enhanced), col_of(instruction)) if enhanced is not None else col_of(instruction)


def recorded_enhancement(enhanced, reasoning=None) -> Column:
    """What the results table records: the model's reasoning text if any, else the rewrite."""
    if reasoning is None:
        return col_of(enhanced)
    return F.coalesce(F.nullif(col_of(reasoning), F.lit("")), col_of(enhanced))
