"""Image references, data URLs and image headers as columns."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .naming import path_name, posix_path
from .text import base64_line, col_of, lenient_base64, strict_json, strip

DATA_URL_PATTERN = r"(?i)data:image/(?:png|jpe?g|webp);base64,([A-Za-z0-9+/=\s]+)"
DEFAULT_CACHE_SUFFIX = ".jpg"


def is_embedded(df: DataFrame, col: str = "input_images") -> bool:
    """Images travel inside the table unless the column is text."""
    return col in df.columns and not isinstance(df.schema[col].dataType, T.StringType)


def parse_input_images(value) -> Column:
    """ARRAY<STRING> from a JSON array, a comma list or a single reference."""
    text = strip(value)
    items = strict_json(F.when(text.startswith("[") & text.endswith("]"), text)).cast("array<variant>")
    listed = F.transform(items, lambda x: (
        F.when(F.schema_of_variant(x) == "BOOLEAN", F.initcap(x.cast("string")))
        .when(F.schema_of_variant(x) == "VOID", F.lit("None"))
        .otherwise(x.cast("string"))))
    split = F.filter(F.transform(F.split(text, ","), strip), lambda x: x != "")
    none = F.array().cast("array<string>")
    return (
        F.when(F.coalesce(text, F.lit("")).isin("", "[]"), none)
        .when(listed.isNotNull(), listed)
        .when(F.contains(text, F.lit(",")), split)
        .otherwise(F.array(text))
    )


def is_remote(ref: Column) -> Column:
    return ref.startswith("http://") | ref.startswith("https://")


def resolve_refs(refs, base_dir: str) -> Column:
    """Relative paths are taken from ``base_dir``; URLs and absolute paths stay."""
    base = base_dir.rstrip("/") or "/"
    return F.transform(col_of(refs), lambda r: F.when(is_remote(r) | r.startswith("/"), r).otherwise(
        posix_path(F.concat(F.lit(base + "/"), r))))


def image_cache_key(url) -> Column:
    """md5 of the URL plus the suffix of its path, '.jpg' when there is none."""
    url = col_of(url)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    name = path_name(F.regexp_replace(path, r";[^/]*$", ""))
    suffix = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    return F.concat(F.md5(url), F.when(suffix != "", suffix).otherwise(F.lit(DEFAULT_CACHE_SUFFIX)))


def classify_image_ref(ref) -> Column:
    """'data', 'http' or 'base64'."""
    ref = col_of(ref)
    return (
        F.when(ref.isNull(), F.lit(None).cast("string"))
        .when(ref.startswith("data:"), F.lit("data"))
        .when(is_remote(ref), F.lit("http"))
        .otherwise(F.lit("base64"))
    )


def decode_image_ref(ref) -> Column:
    """Bytes carried by the reference itself; null for http references and bad base64."""
    ref = col_of(ref)
    kind = classify_image_ref(ref)
    payload = F.try_element_at(F.split(ref, ",", 2), F.lit(2))
    return F.when(kind == "data", lenient_base64(payload)).when(kind == "base64", lenient_base64(ref))


def extract_data_url(text) -> Column:
    """Bytes of the first image data URL inside a text."""
    payload = F.regexp_replace(F.regexp_extract(col_of(text), DATA_URL_PATTERN, 1), r"\s", "")
    return F.when(payload != "", lenient_base64(payload))


# One model reply: candidate parts first, loose parts second.
_PARTS = "ARRAY<STRUCT<text: STRING, inline_data: STRUCT<data: STRING>>>"
MODEL_REPLY_SCHEMA = f"STRUCT<candidates: ARRAY<STRUCT<content: STRUCT<parts: {_PARTS}>>>, parts: {_PARTS}>"


def extract_response_image(reply) -> Column:
    """Image bytes of a reply: candidates' inline data, loose inline data, data URLs in text.

    Inline strings are base64, inline bytes are used as they are. An inline
    string that does not decode gives null; the search does not go on.
    """
    reply = col_of(reply)
    nothing = F.array()
    in_candidates = F.flatten(F.transform(
        F.coalesce(reply["candidates"], nothing),
        lambda c: F.coalesce(c["content"]["parts"], nothing)))
    parts = F.concat(in_candidates, F.coalesce(reply["parts"], nothing))
    with_data = F.filter(parts, lambda p: p["inline_data"]["data"].isNotNull())
    texts = F.filter(F.transform(parts, lambda p: p["text"]), lambda t: F.coalesce(t, F.lit("")) != "")
    urls = F.filter(F.transform(texts, extract_data_url), lambda b: F.length(b) > 0)
    inline = F.try_element_at(with_data, F.lit(1))["inline_data"]["data"]
    first_url = F.try_element_at(urls, F.lit(1))
    decoded = F.when(F.typeof(inline) == "binary", inline.cast("binary")).otherwise(
        lenient_base64(inline.cast("string")))
    return F.when(F.size(with_data) > 0, decoded).otherwise(first_url)


def mime_data_url(data, mime: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), base64_line(data))


def select_input_images(images, rule: str = "all") -> Column:
    """Images a model takes: 'all', 'first' (null when none) or 'first3'."""
    images = col_of(images)
    if rule == "all":
        return images
    if rule == "first":
        first = F.try_element_at(images, F.lit(1))
        return F.when(first.isNotNull(), F.array(first))
    if rule == "first3":
        return F.slice(images, 1, 3)
    raise ValueError(f"unknown rule {rule!r}; use all, first or first3")


def drop_empty_inputs(df: DataFrame, col: str = "images") -> DataFrame:
    return df.where(F.size(F.col(col)) > 0)


_PNG_SIGNATURE = "89504E470D0A1A0A"


def png_header(data) -> Column:
    """STRUCT<format,width,height> of PNG bytes from fixed offsets, null fields otherwise."""
    data = col_of(data)
    ok = (F.hex(F.substring(data, 1, 8)) == _PNG_SIGNATURE) & (F.length(data) >= 24)

    def be32(at):
        return F.conv(F.hex(F.substring(data, at, 4)), 16, 10).cast("int")

    return F.struct(
        F.when(ok, F.lit("PNG")).alias("format"),
        F.when(ok, be32(17)).alias("width"),
        F.when(ok, be32(21)).alias("height"))


IMAGE_HEADER_SCHEMA = "format string, width int, height int"


def _jpeg_size(b: bytes):
    at = 2
    while at + 9 <= len(b) and b[at] == 0xFF:
        marker = b[at + 1]
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", b[at + 5:at + 9])
            return width, height
        at += 2 + struct.unpack(">H", b[at + 2:at + 4])[0]
    return None


def _webp_size(b: bytes):
    kind = b[12:16]
    if kind == b"VP8X" and len(b) >= 30:
        return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
    if kind == b"VP8 " and len(b) >= 30:
        w, h = struct.unpack("<HH", b[26:30])
        return w & 0x3FFF, h & 0x3FFF
    if kind == b"VP8L" and len(b) >= 25:
        bits = int.from_bytes(b[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + ((bits >> 14) & 0x3FFF)
    return None


def _other_header(b):
    if b is None:
        return None, None, None
    b = bytes(b)
    name, size = None, None
    if b[:3] == b"\xff\xd8\xff":
        name, size = "JPEG", _jpeg_size(b)
    elif b[:4] == b"RIFF" and b[8:12] == b"WEBP":
        name, size = "WEBP", _webp_size(b)
    return (name, *size) if size else (None, None, None)


def _other_headers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for blobs in batches:
        found = [_other_header(b) for b in blobs]
        yield pd.DataFrame({
            "format": pd.Series([f[0] for f in found], dtype="object"),
            "width": pd.Series([f[1] for f in found], dtype="Int32"),
            "height": pd.Series([f[2] for f in found], dtype="Int32")})


def image_header(data) -> Column:
    """STRUCT<format,width,height> of PNG, JPEG or WebP bytes; null fields when unreadable.

    PNG never leaves the JVM; only other blobs are handed to Python.
    """
    data = col_of(data)
    png = png_header(data)
    read_other = F.pandas_udf(_other_headers, IMAGE_HEADER_SCHEMA)
    return F.when(png["format"].isNotNull(), png).otherwise(
        read_other(F.when(png["format"].isNull(), data)))
