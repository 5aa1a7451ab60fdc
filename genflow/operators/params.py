"""Model capabilities and call parameters joined to tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.models import (
    DEFAULT_CAPABILITY, DEFAULT_GUIDANCE, DEFAULT_STEPS, capability_table, edit_params, t2i_default_table, t2i_params,
)
from ..storage import stored
from .joins import salted_left_join

#: Longest beginning of a pattern that names are searched for first.
GRAM = 3


def with_capabilities(df: DataFrame, dim: DataFrame | None = None, model_type: str = "model_type") -> DataFrame:
    """Capability record of each model type; unknown types get the default record."""
    # The built-in table has a fixed handful of rows.
    dim = F.broadcast(capability_table(df.sparkSession)) if dim is None else dim
    names = [c for c in dim.columns if c != "model_type"]
    fallback = dict(zip(names, DEFAULT_CAPABILITY[1:]))
    joined = df.join(dim.withColumnRenamed("model_type", "_type"), F.col(model_type) == F.col("_type"), "left")
    filled = [
        F.col(n) if fallback[n] is None or n == "extra_kwargs" else F.coalesce(F.col(n), F.lit(fallback[n])).alias(n)
        for n in names
    ]
    return joined.select(*[F.col(c) for c in df.columns], *filled)


def resolve_edit_params(df: DataFrame, **given) -> DataFrame:
    """Edit call parameters: empty values (null, 0, '') fall back to the model's defaults."""
    return with_capabilities(df).select("*", *[c.alias(n) for n, c in edit_params(**given).items()])


#: Columns of a prompt table that win over the job's setting of the same name, by parameter.
ROW_VALUES = {"height": "height", "width": "width", "negative": "negative_prompt"}


def resolve_t2i_params(df: DataFrame, model_type: str = "model_type", job: dict | None = None, **given) -> DataFrame:
    """Generation call parameters: only null falls back, to the model's or the general default.

    ``job`` holds the job's ``height``, ``width`` and ``negative_prompt``. A
    row's own value wins where the table has such a column and the cell holds
    one; columns of these names come out with the value that counts.
    """
    dim = F.broadcast(t2i_default_table(df.sparkSession).withColumnRenamed("model_type", "_type"))
    joined = df.join(dim, F.col(model_type) == F.col("_type"), "left").drop("_type")
    joined = joined.withColumn("default_steps", F.coalesce("default_steps", F.lit(DEFAULT_STEPS)))
    joined = joined.withColumn("default_guidance", F.coalesce("default_guidance", F.lit(DEFAULT_GUIDANCE)))
    settings = job or {}
    for parameter, name in ROW_VALUES.items():
        if parameter not in given and (name in settings or name in df.columns):
            given[parameter] = (name if name in df.columns else None, settings.get(name))
    return joined.withColumns(t2i_params(**given))


def match_pattern_table(df: DataFrame, patterns: DataFrame, name: str = "name", matched: str = "matched", ordinal: str = "ordinal",
                        pattern: str = "pattern", value: str = "value") -> DataFrame:
    """``df`` with ``matched``: the value of the first pattern (lowest ordinal) that the name contains, in any case, else null.

    For patterns in a table, however many: of equal patterns only the first
    counts. A name's pieces of at most three characters are looked up among the
    patterns' beginnings, which give the sizes of patterns that may start there;
    pieces of those sizes are then looked up among the patterns themselves. So
    the work for a name depends on its length and on how many sizes patterns
    have, not on their number. Each different name is looked up once. Null names
    and patterns match nothing; an empty pattern matches every name; of equal
    ordinals the smaller value wins.
    """
    listed = stored(patterns.where(F.col(pattern).isNotNull()).select(
        F.lower(pattern).alias("_p"), F.struct(F.col(ordinal).alias("_o"), F.col(value).alias("_v")).alias("_first")).groupBy("_p").agg(
        F.min("_first").alias("_first")), "patterns")
    starts = stored(listed.groupBy(F.substring("_p", 1, GRAM).alias("_gram")).agg(F.collect_set(F.length("_p")).alias("_sizes")), "pattern-starts")
    widths = sorted(r["w"] for r in starts.select(F.length("_gram").alias("w")).distinct().collect())  # GRAM + 1 numbers at most
    names = stored(df.select(F.lower(name).alias("_name")).where("_name is not null").distinct(), "pattern-names")

    def pieces(width: int):
        last = F.length("_name") - width + 1 if width else F.lit(1)
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.struct(
            i.alias("_at"), F.substr("_name", i, F.lit(width)).alias("_gram")))).otherwise(F.array().cast("array<struct<_at:int,_gram:string>>"))

    cut = F.concat(F.array().cast("array<struct<_at:int,_gram:string>>"), *[pieces(w) for w in widths])
    cuts = names.select("_name", F.inline(cut))
    near = salted_left_join(cuts, starts, "_gram", ["_name", "_at"]).select("_name", "_at", F.explode("_sizes").alias("_size"))
    near = stored(near.where(F.col("_at") + F.col("_size") - 1 <= F.length("_name")).select(
        "_name", "_at", F.substr("_name", F.col("_at"), F.col("_size")).alias("_p")), "pattern-pieces")
    hits = salted_left_join(near, listed, "_p", ["_name", "_at"]).where("_first is not null")
    first = hits.groupBy("_name").agg(F.min("_first")["_v"].alias(matched))
    joined = df.drop(matched).join(first, F.lower(name) == F.col("_name"), "left")
    return joined.drop("_name")
