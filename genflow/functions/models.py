"""Model names, capabilities, routing and parameter defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .naming import path_name
from .text import col_of, let, strip

# Text-to-image name patterns in match order (some later ones are
# shadowed by earlier, more general ones; the order is part of the behaviour).
MODEL_NAME_PATTERNS = (
    ("FLUX.1", "flux"),
    ("FLUX.2", "flux"),
    ("FLUX", "flux"),
    ("stable-diffusion-3", "sd3"),
    ("stable-diffusion-xl", "sdxl"),
    ("stable-diffusion", "sd"),
    ("HunyuanDiT", "hunyuan"),
    ("PixArt", "pixart"),
    ("CogView", "cogview"),
    ("Qwen-Image-Edit-Plus", "qwen"),
    ("Qwen-Image-Edit-2509", "qwen"),
    ("Qwen-Image-Edit-2511", "qwen"),
    ("Qwen-Image-Edit", "qwen_singleimg"),
    ("FLUX.2-dev", "flux2_edit"),
    ("FLUX.2-klein", "flux2_klein"),
    ("FLUX.1-Kontext", "flux1_kontext"),
    ("LongCat", "longcat"),
    ("GLM-Image", "glm_image"),
)

# Editing name patterns tried after the qwen-image-edit rule.
EDIT_NAME_PATTERNS = (
    ("FLUX.2-dev", "flux2"),
    ("FLUX.2-klein", "flux2_klein"),
    ("FLUX.1-Kontext", "flux1_kontext"),
    ("LongCat", "longcat"),
    ("GLM-Image", "glm_image"),
)
QWEN_EDIT_NAME = "qwen-image-edit"

CAPABILITY_SCHEMA = (
    "model_type string, pipeline_class string, multi_image boolean, batch_disabled boolean, "
    "shared_image_batch boolean, use_true_cfg boolean, use_negative_prompt boolean, "
    "default_steps int, default_guidance double, default_true_cfg double, "
    "extra_kwargs map<string,string>"
)

# Editing model capabilities and defaults, one row per model type.
EDIT_CAPABILITIES = (
    ("qwen", "QwenImageEditPlusPipeline", True, True, False, True, False, 40, 1.0, 4.0, {}),
    ("qwen_singleimg", "QwenImageEditPipeline", False, False, False, True, False, 50, 1.0, 4.0, {}),
    ("flux2", "Flux2Pipeline", True, False, True, False, False, 28, 4.0, 4.0, {}),
    ("flux2_klein", "Flux2KleinPipeline", True, False, True, False, False, 4, 1.0, 4.0, {}),
    ("flux1_kontext", "FluxKontextPipeline", False, False, True, False, False, 30, 2.5, 4.0, {}),
    ("longcat", "LongCatImageEditPipeline", False, True, False, False, True, 50, 4.5, 4.0, {}),
    ("glm_image", "GlmImagePipeline", True, True, False, False, False, 50, 1.5, 4.0, {}),
)
DEFAULT_CAPABILITY = (None, None, False, False, False, False, False, 28, 3.5, 4.0, {})

# Text-to-image defaults (model type, steps, guidance).
T2I_DEFAULTS = (
    ("flux", 28, 3.5),
    ("sd3", 28, 7.0),
    ("sdxl", 30, 7.5),
    ("sd", 50, 7.5),
    ("hunyuan", 50, 5.0),
    ("pixart", 20, 4.5),
    ("cogview", 50, 7.5),
)
DEFAULT_STEPS, DEFAULT_GUIDANCE = 28, 3.5

# Backend families.
DIFFUSERS_EDIT_TYPES = tuple(row[0] for row in EDIT_CAPABILITIES)
THIRD_PARTY_EDIT_TYPES = (
    "flux_kontext_official", "bagel", "step1x", "emu35", "dreamomni2", "hunyuan_image_3", "deepgen",
)
T2I_BACKENDS = ("diffusers", "xdit", "openai", "deepgen")
GOOGLE_NAMES = ("google_genai", "gemini")


def match_patterns(name, patterns: Sequence[tuple[str, str]]) -> Column:
    """Value of the first listed pattern contained in ``name`` (any case), else null.

    The pattern list is configuration, so it becomes one CASE expression and
    no join at all.
    """
    def first(lowered: Column) -> Column:
        return F.coalesce(*[F.when(F.contains(lowered, F.lit(p.lower())), F.lit(v)) for p, v in patterns])

    return let(F.lower(col_of(name)), first)


def detect_model_type(name) -> Column:
    return match_patterns(name, MODEL_NAME_PATTERNS)


def _qwen_edit_type(lowered: Column) -> Column:
    at = F.locate(QWEN_EDIT_NAME, lowered)
    following = F.substring(lowered, at + len(QWEN_EDIT_NAME), F.lit(1))
    return (
        F.when(F.contains(lowered, F.lit(QWEN_EDIT_NAME + "-")), F.lit("qwen"))
        .when((at > 0) & ~following.rlike(r"^[\p{L}\p{N}]$"), F.lit("qwen_singleimg"))
    )


def detect_edit_model_type(name) -> Column:
    name = col_of(name)
    return F.coalesce(
        let(F.lower(name), _qwen_edit_type),
        let(F.lower(path_name(name)), _qwen_edit_type),
        match_patterns(name, EDIT_NAME_PATTERNS))


def route_edit_backend(backend, model_type, custom: Sequence[str] = ()) -> Column:
    """STRUCT<route,error> of the editing backend that serves a request."""
    backend, model_type = F.lower(col_of(backend)), col_of(model_type)
    third = F.coalesce(F.nullif(model_type, F.lit("")), backend)
    third_party = model_type.isin(*THIRD_PARTY_EDIT_TYPES) | backend.isin(*THIRD_PARTY_EDIT_TYPES)
    route = (
        F.when((backend == "diffusers") | F.coalesce(model_type.isin(*DIFFUSERS_EDIT_TYPES), F.lit(False)),
               F.lit("diffusers"))
        .when(backend == "openai", F.lit("openai"))
        .when(backend.isin(*GOOGLE_NAMES), F.lit("google_genai"))
        .when(third_party & third.isin(*THIRD_PARTY_EDIT_TYPES), third)
    )
    return _routed(route, backend, custom)


def route_t2i_backend(backend, custom: Sequence[str] = ()) -> Column:
    backend = F.lower(col_of(backend))
    route = F.when(backend.isin(*T2I_BACKENDS), backend).when(backend.isin(*GOOGLE_NAMES), F.lit("google_genai"))
    return _routed(route, backend, custom)


def _routed(route: Column, backend: Column, custom: Sequence[str]) -> Column:
    if custom:
        route = F.coalesce(route, F.when(backend.isin(*custom), backend))
    unknown = F.concat(F.lit("unknown backend: "), F.coalesce(backend, F.lit("")))
    return F.struct(route.alias("route"), F.when(route.isNull(), unknown).alias("error"))


def edit_params(steps=None, guidance=None, true_cfg=None, negative=None) -> dict[str, Column]:
    """Parameters of an edit call; 0 and '' fall back to the model default like null does.

    Expects the capability columns to be attached already.
    """
    def given(value, dtype):
        return F.lit(None).cast(dtype) if value is None else F.nullif(col_of(value).cast(dtype), F.lit(0).cast(dtype))

    negative_text = F.lit(None).cast("string") if negative is None else F.nullif(col_of(negative), F.lit(""))
    return {
        "num_inference_steps": F.coalesce(given(steps, "int"), F.col("default_steps")),
        "guidance_scale": F.coalesce(given(guidance, "double"), F.col("default_guidance")),
        "true_cfg_scale": F.when(F.col("use_true_cfg"), F.coalesce(given(true_cfg, "double"), F.col("default_true_cfg"))),
        "negative_prompt": F.when(F.col("use_negative_prompt"), negative_text),
    }


def t2i_params(steps=None, guidance=None, height=None, width=None, negative=None) -> dict[str, Column]:
    """Parameters of a generation call; only null falls back, 0 is kept.

    For the last three a pair (row's value, job's value) may be given: the row's
    wins unless it is null, or blank for a text.
    """
    def given(value, dtype):
        return F.lit(None).cast(dtype) if value is None else col_of(value).cast(dtype)

    def of_row(value, dtype):
        own, job = value if isinstance(value, tuple) else (value, None)
        own = given(own, dtype)
        if dtype == "string":
            own = F.when(strip(own) != "", own)
        return F.coalesce(own, F.lit(job).cast(dtype))

    return {
        "num_inference_steps": F.coalesce(given(steps, "int"), F.col("default_steps")),
        "guidance_scale": F.coalesce(given(guidance, "double"), F.col("default_guidance")),
        **({"height": of_row(height, "int")} if height is not None else {}),
        **({"width": of_row(width, "int")} if width is not None else {}),
        **({"negative_prompt": of_row(negative, "string")} if negative is not None else {}),
    }


def inference_kwargs(width=None, height=None, quality=None, steps: int = 0, guidance: float = 0.0) -> Column:
    """MAP of only the arguments that have a value; overrides count when above zero."""
    pairs = {"width": width, "height": height, "quality": quality}
    entries = []
    for name, value in pairs.items():
        if value is not None:
            entries += [F.lit(name), col_of(value).cast("string")]
    if steps > 0:
        entries += [F.lit("num_inference_steps"), F.lit(str(steps))]
    if guidance > 0:
        entries += [F.lit("guidance_scale"), F.lit(str(guidance))]
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def capability_table(spark) -> DataFrame:
    return spark.createDataFrame(list(EDIT_CAPABILITIES), CAPABILITY_SCHEMA)


def t2i_default_table(spark) -> DataFrame:
    return spark.createDataFrame(list(T2I_DEFAULTS), "model_type string, default_steps int, default_guidance double")
