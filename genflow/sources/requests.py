"""Request records with their declared fields and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import col_of

# Request fields, types and defaults.
_COMMON = "prompt STRING, model STRING, n INT, size STRING, quality STRING, response_format STRING, " \
          "output_format STRING, output_compression INT, background STRING, user STRING"
GENERATE_SCHEMA = f"STRUCT<{_COMMON}, moderation STRING, style STRING>"
_REF = "STRUCT<image_url: STRING, file_id: STRING>"
EDIT_SCHEMA = f"STRUCT<{_COMMON}, images ARRAY<{_REF}>, mask {_REF}, input_fidelity STRING>"
# Both kinds of request in one column, for a mixed log.
REQUEST_SCHEMA = f"STRUCT<{_COMMON}, moderation STRING, style STRING, images ARRAY<{_REF}>, mask {_REF}, input_fidelity STRING>"
DEFAULTS = {"n": 1, "response_format": "b64_json", "output_format": "png"}


def parse_request(body, schema: str = REQUEST_SCHEMA) -> Column:
    """Parsed body with defaults where a field is absent; null when it is not a JSON object."""
    body = col_of(body)
    parsed = F.from_json(body, schema)
    is_object = F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT")
    filled = parsed
    for name, value in DEFAULTS.items():
        filled = filled.withField(name, F.coalesce(parsed[name], F.lit(value)))
    return F.when(is_object, filled)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("body"), parse_request("value", schema).alias("request"))


def read_generate_requests(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, GENERATE_SCHEMA)


def read_edit_requests(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, EDIT_SCHEMA)
