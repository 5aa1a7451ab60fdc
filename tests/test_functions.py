"""Column functions on the cases the tables do not hold."""

import math
import random
from math import gcd

import pytest
from pyspark.sql import functions as F

from genflow.functions.attempts import RetryPolicy, normalize_base_url, retry_wait
from genflow.functions.images import (
    classify_image_ref, decode_image_ref, image_cache_key, is_embedded, parse_input_images, resolve_refs,
)
from genflow.functions.models import detect_edit_model_type, detect_model_type, inference_kwargs, route_edit_backend
from genflow.functions.prompts import (
    dominant_language, final_instruction, parse_enhance_response, recorded_enhancement, render_template, strip_gen_tags,
)
from genflow.functions.sizes import aspect_ratio, cap_dims, nearest_aspect, nearest_size, parse_size, plan_resize
from genflow.functions.text import preview
from genflow.operators.params import resolve_edit_params, resolve_t2i_params
from genflow.operators.reports import key_category


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def by_text(spark, cases, column):
    """{text: value} of ``column`` over the column ``t``."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


REPLIES = [
    ('```json\n{"Rewritten": "x\\ny"}\n```', "qwen_image_edit", "o", "x y"),
    ('{"Other": 1}', "qwen_image_edit", "o", "o"),
    ('{"Other": 1}', "qwen_image_edit", " o\np ", "o p"),
    ("not json", "qwen_image_edit", " o\np ", " o\np "),
    ('{"Rewritten": 3}', "qwen_image_edit", "o", "o"),
    ('{"Rewritten": null}', "qwen_image_edit", "o", "o"),
    ('["Rewritten"]', "qwen_image_edit", "o", "o"),
    ('{"Rewritten": "a"} trailing', "qwen_image_edit", "o", "o"),
    ("```json```json{}", "qwen_image_edit", "o", "o"),
    (None, "qwen_image_edit", "o", "o"),
    ("  x  ", "glm_image", "o", "x"),
    ("```\nx\n```", "flux2", "o", "x"),
    ("```text\nx\n```", "flux2", "o", "text\nx"),
    ("```", "flux2", "o", ""),
    (" plain ``` inside ", "flux2", "o", "plain ``` inside"),
]


@pytest.mark.parametrize("raw,style,original,want", REPLIES)
def test_replies(spark, raw, style, original, want):
    assert one(spark, parse_enhance_response(F.lit(raw).cast("string"), F.lit(original), style)) == want


def test_gen_tags(spark):
    texts = ["<gen> x </gen>", "<gen></gen>", "<gen>x", "  ", "y "]
    assert by_text(spark, texts, strip_gen_tags("t", F.lit("o"))) == ["x", "o", "<gen>x", "o", "y"]


def test_language(spark):
    texts = ["", "中文 two words", "中 two words", "été", "123", None]
    assert by_text(spark, texts, dominant_language("t")) == ["zh", "zh", "en", "en", "zh", "zh"]


def test_instruction_and_enhancement(spark):
    assert one(spark, final_instruction(F.lit("a"), F.lit(None).cast("string"))) == "a"
    assert one(spark, recorded_enhancement(F.lit("e"), F.lit("why"))) == "why"
    assert one(spark, recorded_enhancement(F.lit(None).cast("string"), F.lit(None).cast("string"))) is None
    assert one(spark, render_template("{a}-{b}-{a}", a=F.lit("x"), b=3)) == "x-3-x"
    assert one(spark, preview(F.lit("abcdef"), 3)) == "abc..."


def test_input_images(spark):
    texts = ['["a", 1, true, null]', "a, b ,,", " one ", "[]", "", "  ", '{"a": 1}', "[1] x", "[broken, x", "['a']", '"s"']
    want = [["a", "1", "True", "None"], ["a", "b"], ["one"], [], [], [], ['{"a": 1}'], ["[1] x"], ["[broken", "x"], ["['a']"], ['"s"']]
    assert by_text(spark, texts, parse_input_images("t")) == want


def test_references(spark):
    refs = F.array(*[F.lit(r) for r in ("http://h/a", "https://h", "/abs/x", "rel//./y", "../up")])
    assert one(spark, resolve_refs(refs, "/in/dir/")) == ["http://h/a", "https://h", "/abs/x", "/in/dir/rel/y", "/in/dir/../up"]
    urls = ["http://h/a/b.PNG?x=1.gif#f", "http://h/", "http://h.com", "http://h/a.b/c", "http://h/x.tar.gz;v=1"]
    assert [k[32:] for k in by_text(spark, urls, image_cache_key("t"))] == [".PNG", ".jpg", ".jpg", ".jpg", ".gz"]
    texts = ["data:image/png;base64,aGk=", "http://x", "aGk=", "aGk", "data:nope", "a G\nk=", None]
    assert by_text(spark, texts, classify_image_ref("t")) == ["data", "http", "base64", "base64", "data", "base64", None]
    assert [v and bytes(v) for v in by_text(spark, texts, decode_image_ref("t"))] == [b"hi", None, b"hi", None, None, b"hi", None]


def test_embedded_is_a_property_of_the_column(spark):
    assert not is_embedded(spark.createDataFrame([("x",)], "input_images string"))
    assert is_embedded(spark.createDataFrame([], "input_images array<struct<bytes:binary,path:string>>"))


def test_base_urls(spark):
    texts = ["http://p1/v1beta/", "http://p2//", "http://p3/v1", "http://h/v1alpha", "http://h/v1/v1", "", None]
    rows = by_text(spark, texts, normalize_base_url("t"))
    assert [tuple(r) for r in rows] == [
        ("http://p1", "v1beta"), ("http://p2", None), ("http://p3", "v1"), ("http://h", "v1alpha"), ("http://h/v1", "v1"), (None, None), (None, None)]
    assert tuple(one(spark, normalize_base_url(F.lit("http://x/v1"), F.lit("v2")))) == ("http://x", "v2")


NAMES = [
    ("black-forest-labs/FLUX.2-dev", "flux", "flux2"), ("Qwen/Qwen-Image-Edit", "qwen_singleimg", "qwen_singleimg"),
    ("Qwen/Qwen-Image-Edit-2511", "qwen", "qwen"), ("x/qwen-image-edit_v2", "qwen_singleimg", "qwen_singleimg"),
    ("x/qwen-image-editor", "qwen_singleimg", None), ("stabilityai/stable-diffusion-3-medium", "sd3", None),
    ("other/model", None, None), ("qwen-image-editor/qwen-image-edit", "qwen_singleimg", "qwen_singleimg"),
]


def test_model_names(spark):
    texts = [n for n, _, _ in NAMES]
    assert by_text(spark, texts, detect_model_type("t")) == [t for _, t, _ in NAMES]
    assert by_text(spark, texts, detect_edit_model_type("t")) == [e for _, _, e in NAMES]


ROUTES = [
    ("diffusers", "bagel", "diffusers"), ("openai", "qwen", "diffusers"), ("openai", "bagel", "openai"), ("GEMINI", None, "google_genai"),
    ("bagel", None, "bagel"), ("x", "step1x", "step1x"), ("bagel", "odd", None), ("mine", None, "mine"), ("x", None, None),
]


def test_routes(spark):
    df = spark.createDataFrame([(i, b, m) for i, (b, m, _) in enumerate(ROUTES)], "i int, b string, m string")
    rows = df.select("i", route_edit_backend("b", "m", ["mine"]).alias("r")).orderBy("i").collect()
    assert [r["r"]["route"] for r in rows] == [w for _, _, w in ROUTES]
    assert rows[-1]["r"]["error"] == "unknown backend: x" and rows[0]["r"]["error"] is None


def test_null_rules_of_parameters(spark):
    df = spark.createDataFrame([(0, "qwen", 0, ""), (1, "longcat", 7, "bad"), (2, None, None, "bad")], "i int, model_type string, steps int, neg string")
    rows = resolve_edit_params(df, steps="steps", negative="neg").orderBy("i").collect()
    assert [(r["num_inference_steps"], r["true_cfg_scale"], r["negative_prompt"]) for r in rows] == [(40, 4.0, None), (7, None, "bad"), (28, None, None)]
    t2i = spark.createDataFrame([(0, "sd", 0), (1, "sd", None), (2, "?", None)], "i int, model_type string, steps int")
    assert [r["num_inference_steps"] for r in resolve_t2i_params(t2i, steps="steps").orderBy("i").collect()] == [0, 50, 28]
    assert one(spark, inference_kwargs(F.lit(None).cast("int"), F.lit(5), None, guidance=2.5)) == {"height": "5", "guidance_scale": "2.5"}


def test_sizes(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(1, 5000), rng.randint(1, 5000)) for _ in range(500)] + [(1, 1), (512, 512), (1024, 1), (2**31 - 1, 1836311903)]
    df = spark.createDataFrame([(i, w, h) for i, (w, h) in enumerate(pairs)], "i int, w int, h int")
    rows = df.select("i", aspect_ratio("w", "h").alias("a"), plan_resize("w", "h").alias("f"), plan_resize("w", "h", "dynamic").alias("d"),
                     cap_dims("w", "h").alias("c"), nearest_aspect("w", "h", [(1024, 1024), (672, 1568)]).alias("n")).orderBy("i").collect()
    for (w, h), r in zip(pairs, rows):
        g = gcd(w, h)
        assert r["a"] == f"{w // g}:{h // g}"
        if w > 5000:
            continue
        ratio = 512 / math.sqrt(h * w)
        assert tuple(r["f"]) == (math.ceil(w * ratio / 32) * 32, math.ceil(h * ratio / 32) * 32)
        assert max(r["d"]) == 512 if max(w, h) >= 512 else max(r["d"]) == math.ceil(max(w, h) / 32) * 32
        scale = 2000 / max(w, h)
        assert tuple(r["c"]) == ((int(w * scale), int(h * scale)) if max(w, h) > 2000 else (w, h))
        assert tuple(r["n"]) == min((abs(w / h - a / b), a, b) for a, b in [(1024, 1024), (672, 1568)])[1:]


def test_size_edges(spark):
    assert one(spark, plan_resize(F.lit(0), F.lit(5))) is None
    assert one(spark, aspect_ratio(F.lit(0), F.lit(5))) is None
    assert one(spark, nearest_size(F.lit(None).cast("int"), F.lit(None).cast("int"))) == "1024x1024"
    assert one(spark, nearest_size(F.lit(0), F.lit(1700))) == "1024x1792"
    assert one(spark, nearest_size(F.lit(384), F.lit(384))) == "256x256"
    with pytest.raises(ValueError, match="width and height"):
        plan_resize("w", "h", "direct")
    with pytest.raises(ValueError, match="unknown resize mode"):
        plan_resize("w", "h", "odd")
    texts = ["1024x768", "1024X768", " 1 x 2 ", "auto", "", None, "12x", "1x2x3", "ax1", "99999999999x1"]
    assert [tuple(r) for r in by_text(spark, texts, parse_size("t"))] == [(1024, 768), (1024, 768), (1, 2)] + [(None, None)] * 7


def test_waits(spark):
    policy = RetryPolicy(retries=3, delay=1.0, backoff=2.0, cap=3.0)
    assert [policy.wait(k) for k in range(4)] == [1.0, 2.0, 3.0, 0.0]
    df = spark.range(4).select("id", retry_wait("id", policy).alias("w")).orderBy("id")
    assert [r["w"] for r in df.collect()] == [1.0, 2.0, 3.0, 0.0]
    assert RetryPolicy().attempts == 1 and RetryPolicy(retries=-3).attempts == 1


def test_key_categories(spark):
    keys = ["transformer.a", "lmm.lora_A", "connector.x", "vae.d", "meta_queries", "projector_1", "zzz", "x.vae.", "LoRA"]
    assert by_text(spark, keys, key_category("t")) == ["transformer", "lora", "connector", "vae", "meta_queries", "projector", "other", "other", "lora"]
