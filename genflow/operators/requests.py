"""Checking request records and building responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.images import classify_image_ref, decode_image_ref
from ..functions.sizes import parse_size
from ..functions.text import base64_line

DEFAULT_FORMAT = "png"

# Rejection texts by rule.
DETAIL_MODE_T2I = "This server is not configured for image generation (T2I)"
DETAIL_MODE_EDIT = "This server is not configured for image editing"
DETAIL_BODY = "Request body is not valid JSON"
DETAIL_PROMPT = "'prompt' field is required"
DETAIL_FILE_ID = "file_id references are not supported. Use image_url instead."
DETAIL_IMAGE_URL = "Invalid image_url: not a valid URL, data-URL, or base64 string"
DETAIL_NO_IMAGE = "At least one image is required"


def checked_requests(df: DataFrame, kind: str = "kind", request: str = "request", mode: str | None = None) -> DataFrame:
    """Add ``_status``, ``_detail`` and the settled n, format and size of each request.

    ``request`` is a parsed body, ``kind`` 't2i' or 'edit'. The first rule that
    fails decides. With ``mode`` only requests of that kind are accepted.
    """
    r = F.col(request)
    edit = F.col(kind) == "edit"
    fields = df.schema[request].dataType.fieldNames()
    checks = []
    if mode is not None:
        other = F.lit(DETAIL_MODE_EDIT) if mode == "t2i" else F.lit(DETAIL_MODE_T2I)
        wrong = F.col(kind) != mode
        # A generation body is read before the mode is looked at, an edit body after.
        checks.append((edit & wrong, F.lit(400), other))
    checks.append((r.isNull(), F.lit(422), F.lit(DETAIL_BODY)))
    checks.append((r["prompt"].isNull() | (edit & (r["prompt"] == "")), F.lit(422), F.lit(DETAIL_PROMPT)))
    if mode is not None:
        checks.append((wrong, F.lit(400), other))
    if "images" in fields:
        refs = F.filter(F.coalesce(r["images"], F.array()), lambda x: _given(x["image_url"]) | _given(x["file_id"]))
        problems = F.filter(F.transform(refs, _ref_problem), lambda p: p.isNotNull())
        first = F.try_element_at(problems, F.lit(1))
        checks.append((edit & first.isNotNull(), F.lit(400), first))
        if "mask" in fields:
            bad_mask = _given(r["mask"]["image_url"]) & _undecodable(r["mask"]["image_url"])
            checks.append((edit & F.coalesce(bad_mask, F.lit(False)), F.lit(400), F.lit(DETAIL_IMAGE_URL)))
        checks.append((edit & (F.size(refs) == 0), F.lit(422), F.lit(DETAIL_NO_IMAGE)))
    status = F.coalesce(*[F.when(c, s) for c, s, _ in checks], F.lit(200))
    detail = F.coalesce(*[F.when(c, d) for c, _, d in checks])
    size = parse_size(r["size"])
    return df.select(
        "*", status.alias("_status"), detail.alias("_detail"),
        settled_n(r["n"]).alias("_n"),
        F.lower(F.coalesce(F.nullif(r["output_format"], F.lit("")), F.lit(DEFAULT_FORMAT))).alias("_format"),
        size["w"].alias("_width"), size["h"].alias("_height"))


def settled_n(n: Column) -> Column:
    return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1))


def _given(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def _undecodable(url: Column) -> Column:
    return (classify_image_ref(url) != "http") & decode_image_ref(url).isNull()


def _ref_problem(ref: Column) -> Column:
    return (
        F.when(_given(ref["image_url"]), F.when(_undecodable(ref["image_url"]), F.lit(DETAIL_IMAGE_URL)))
        .when(_given(ref["file_id"]), F.lit(DETAIL_FILE_ID))
    )


def validate_requests(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) requests."""
    checked = checked_requests(df, **options)
    return checked.where(F.col("_status") == 200), checked.where(F.col("_status") != 200)


def collect_outputs(calls: DataFrame, request: str = "request_id", sub: str = "sub", images: str = "images") -> DataFrame:
    """All images of a request, in call order; a group is the n calls one request asked for."""
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce(F.col(sub), F.lit(0)).alias("sub"), F.col(images).alias("v"))))
    return calls.groupBy(request).agg(F.flatten(F.transform(ordered, lambda x: x["v"])).alias(images))


def build_image_responses(outputs: DataFrame, created: Column, images: str = "images", fmt: str = "_format") -> DataFrame:
    """JSON response text per request: created, data with base64 images, output format."""
    data = F.transform(images, lambda b: F.struct(base64_line(b).alias("b64_json")))
    response = F.struct(created.cast("bigint").alias("created"), data.alias("data"), F.col(fmt).alias("output_format"))
    return outputs.withColumn("response", F.to_json(response))
