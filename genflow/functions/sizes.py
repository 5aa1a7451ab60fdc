"""Target sizes and aspect ratios; pixels themselves are never touched here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .text import col_of

# Sizes an image API accepts, in preference order for ties.
API_SIZES = ((256, 256), (512, 512), (1024, 1024), (1792, 1024), (1024, 1792))
DEFAULT_SIDE = 1024
RESIZE_UNIT = 32
RESIZE_MODES = ("fix_pixels", "dynamic", "direct")


def _pair(w: Column, h: Column) -> Column:
    return F.struct(w.cast("int").alias("w"), h.cast("int").alias("h"))


def _up(x: Column, unit: int) -> Column:
    return F.ceil(x / F.lit(unit)) * F.lit(unit)


def plan_resize(w, h, mode: str = "fix_pixels", image_size: int = 512,
                width: int | None = None, height: int | None = None,
                unit: int = RESIZE_UNIT) -> Column:
    """STRUCT<w,h> an image of w x h should be resized to; null for unknown sizes."""
    w, h = col_of(w).cast("double"), col_of(h).cast("double")
    known = (w > 0) & (h > 0)
    if mode == "fix_pixels":
        ratio = F.lit(float(image_size)) / F.sqrt(h * w)
        planned = _pair(_up(w * ratio, unit), _up(h * ratio, unit))
    elif mode == "dynamic":
        size = F.lit(float(image_size))
        planned = (
            F.when((w >= h) & (w >= size), _pair(size, _up(h * (size / w), unit)))
            .when((h >= w) & (h >= size), _pair(_up(w * (size / h), unit), size))
            .otherwise(_pair(_up(w, unit), _up(h, unit)))
        )
    elif mode == "direct":
        if width is None or height is None:
            raise ValueError("direct resize needs width and height")
        planned = _pair(_up(F.lit(float(width)), unit), _up(F.lit(float(height)), unit))
    else:
        raise ValueError(f"unknown resize mode {mode!r}; use one of {', '.join(RESIZE_MODES)}")
    return F.when(known, planned)


def cap_dims(w, h, limit: int = 2000, unit: int = 1) -> Column:
    """Scale down to ``limit`` on the longer edge, truncated to ``unit``; smaller sizes stay."""
    w, h = col_of(w), col_of(h)
    longest = F.greatest(w, h)
    # Nothing is scaled at or below the limit, so a zero edge never divides.
    ratio = F.lit(float(limit)) / F.when(longest > limit, longest).cast("double")

    def scaled(x):
        return (F.floor((x * ratio).cast("int") / F.lit(unit)) * F.lit(unit)).cast("int")

    return F.when(longest > limit, _pair(scaled(w), scaled(h))).otherwise(_pair(w, h))


def _size_array(sizes: Sequence[tuple[int, int]]) -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("o"), F.lit(a).alias("w"), F.lit(b).alias("h"))
        for i, (a, b) in enumerate(sizes)
    ])


def nearest_size(w, h, sizes: Sequence[tuple[int, int]] = API_SIZES) -> Column:
    """'WxH' with the smallest |dw|+|dh|; the first listed wins a tie."""
    w, h = col_of(w), col_of(h)
    side = F.lit(DEFAULT_SIDE)
    tw = F.coalesce(F.nullif(w, F.lit(0)), side)
    th = F.coalesce(F.nullif(h, F.lit(0)), side)
    best = F.array_min(F.transform(_size_array(sizes), lambda s: F.struct(
        (F.abs(s["w"] - tw) + F.abs(s["h"] - th)).alias("d"), s["o"].alias("o"),
        s["w"].alias("w"), s["h"].alias("h"))))
    found = F.concat_ws("x", best["w"], best["h"])
    return F.when(w.isNull() & h.isNull(), F.lit(f"{DEFAULT_SIDE}x{DEFAULT_SIDE}")).otherwise(found)


def nearest_aspect(w, h, sizes: Sequence[tuple[int, int]], unit: int = 16) -> Column:
    """STRUCT<w,h> of the listed size with the closest ratio, floored to ``unit``."""
    w, h = col_of(w), col_of(h)
    ratio = w.cast("double") / F.nullif(h, F.lit(0)).cast("double")
    best = F.array_min(F.transform(_size_array(sizes), lambda s: F.struct(
        F.abs(ratio - s["w"].cast("double") / s["h"].cast("double")).alias("d"),
        s["w"].alias("w"), s["h"].alias("h"))))
    return F.when(ratio.isNotNull(), _pair(F.floor(best["w"] / unit) * unit, F.floor(best["h"] / unit) * unit))


def gcd(a, b) -> Column:
    """Greatest common divisor of two positive integers (Euclid; 92 steps cover 64 bits)."""
    a, b = col_of(a).cast("bigint"), col_of(b).cast("bigint")
    start = F.struct(a.alias("x"), b.alias("y"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(92)), start, lambda s, _: F.when(
        s["y"] == 0, s).otherwise(F.struct(s["y"].alias("x"), F.pmod(s["x"], s["y"]).alias("y"))))
    return end["x"]


def aspect_ratio(w, h) -> Column:
    """'16:9'-style reduced ratio; null when a side is missing or zero."""
    w, h = col_of(w).cast("bigint"), col_of(h).cast("bigint")
    g = gcd(w, h)
    ratio = F.concat_ws(":", F.floor(w / g), F.floor(h / g))
    return F.when((w > 0) & (h > 0), ratio)


def parse_size(size) -> Column:
    """STRUCT<w,h> of a 'WxH' text, any case; null fields for '', 'auto' or anything else."""
    size = col_of(size)
    pattern = r"(?i)^\s*([+-]?\d+)\s*x\s*([+-]?\d+)\s*$"

    def part(i):
        return F.regexp_extract(size, pattern, i).try_cast("int")

    both = part(1).isNotNull() & part(2).isNotNull()
    return F.struct(F.when(both, part(1)).alias("w"), F.when(both, part(2)).alias("h"))
