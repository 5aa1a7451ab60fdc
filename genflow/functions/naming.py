"""Output names: default numbered names and user-chosen relative paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import col_of, let, strip

# Suffixes kept as they are; anything else gets DEFAULT_SUFFIX appended.
KEPT_SUFFIXES = (".png", ".jpg", ".jpeg")
DEFAULT_SUFFIX = ".png"


def output_filename(index, sub=None) -> Column:
    """``000042.png`` or ``000042_03.png``; wider numbers are never cut."""
    if sub is None:
        return F.format_string("%06d.png", col_of(index))
    sub = F.lit(sub) if isinstance(sub, int) else col_of(sub)
    return F.format_string("%06d%s.png", col_of(index), sub_suffix(sub))


def sub_suffix(sub: Column) -> Column:
    return F.when(sub.isNull(), F.lit("")).otherwise(F.format_string("_%02d", sub))


def path_segments(path: Column) -> Column:
    """Segments left after dropping empty and '.' ones ('..' is kept)."""
    return F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))


def posix_path(path) -> Column:
    """Lexically normalised POSIX path; '.' when nothing is left."""
    # Most paths have nothing to drop and are returned as they are.
    return let(col_of(path), lambda p: F.when(p.rlike(r"(^|/)\.?(/|$)"), _normalised(p)).otherwise(p))


def _normalised(path: Column) -> Column:
    root = (
        F.when(path.startswith("//") & ~path.startswith("///"), F.lit("//"))
        .when(path.startswith("/"), F.lit("/"))
        .otherwise(F.lit(""))
    )
    joined = F.concat(root, F.array_join(path_segments(path), "/"))
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("."))


def path_name(path) -> Column:
    """Last segment of a path, '' when there is none."""
    return F.coalesce(F.try_element_at(path_segments(col_of(path)), F.lit(-1)), F.lit(""))


def normalize_output_path(name, sub=None) -> Column:
    """Relative output path for a user-supplied name; null for a blank one."""
    if sub is None:
        middle = F.lit("")
    else:
        middle = sub_suffix(F.lit(sub) if isinstance(sub, int) else col_of(sub))

    def finished(path: Column) -> Column:
        lowered = F.lower(path)
        suffix = F.coalesce(*[F.when(lowered.endswith(s), F.lit(s)) for s in KEPT_SUFFIXES], F.lit(""))
        base = F.substring(path, F.lit(1), F.length(path) - F.length(suffix))
        # A name that is only dots in front of the suffix has no suffix.
        kept = (suffix != "") & (F.ltrim(F.substring_index(base, "/", -1), F.lit(".")) != "")
        return F.when(kept, F.concat(base, middle, suffix)).otherwise(F.concat(path, middle, F.lit(DEFAULT_SUFFIX)))

    return let(posix_path(F.nullif(strip(name), F.lit(""))), lambda path: F.when(path.isNotNull(), finished(path)))


def expected_output(index="index", name=None, n: int = 1, sub=None) -> Column:
    """Path a task will write: its own name when given, else the numbered one.

    With several images per task the probe is sub-index 0 unless ``sub`` says
    otherwise.
    """
    if sub is None and n > 1:
        sub = 0
    numbered = output_filename(index, sub)
    if name is None:
        return numbered
    return F.coalesce(normalize_output_path(name, sub), numbered)


def with_index(df: DataFrame, col: str = "index", fallback: str | None = None) -> DataFrame:
    """Integer ``index``; rows that cannot be read as one use ``fallback`` or are skipped."""
    if col not in df.columns:
        if fallback is None:
            raise ValueError(f"no column {col!r} and no fallback position")
        return df.withColumn("index", F.col(fallback).cast("bigint"))
    value = F.col(col).try_cast("bigint")
    if fallback is not None:
        return df.withColumn("index", F.coalesce(value, F.col(fallback).cast("bigint")))
    return df.withColumn("index", value).where(F.col("index").isNotNull())


def select_instruction(df: DataFrame, key: str = "instruction") -> Column:
    """The instruction column, '' when the table has none or the cell is missing."""
    return F.coalesce(F.col(key), F.lit("")) if key in df.columns else F.lit("")


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.coalesce(strip(col), F.lit("")) != "")
