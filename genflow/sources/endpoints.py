"""Endpoint tables from comma-separated settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import blank_to_null, col_of, strip

DEFAULT_RATE, DEFAULT_WEIGHT = 0, 1
ENDPOINT_SCHEMA = "endpoint int, base_url string, rate_limit int, weight int, n_keys int"


def _numbers(value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) != "", F.transform(F.split(value, ","), lambda x: strip(x).cast("int")))


def endpoint_lists(urls, keys, rates, weights) -> Column:
    """ARRAY<STRUCT<endpoint,base_url,rate_limit,weight,n_keys>> from four comma lists.

    A blank URL is the default endpoint (null). Every endpoint may use all
    keys; only their number is kept, never a key. Short lists fall back to no
    limit and weight 1. Without URLs and keys there is no endpoint.
    """
    urls, keys, rates, weights = (col_of(c) for c in (urls, keys, rates, weights))
    urls_text, keys_text = F.coalesce(urls, F.lit("")), F.coalesce(keys, F.lit(""))
    base = F.transform(F.split(urls_text, ","), blank_to_null)
    n_keys = F.size(F.filter(F.transform(F.split(keys_text, ","), strip), lambda k: k != ""))
    rate_list, weight_list = _numbers(rates), _numbers(weights)

    def entry(url, i):
        return F.struct(
            i.alias("endpoint"), url.alias("base_url"),
            F.coalesce(F.try_element_at(rate_list, i + 1), F.lit(DEFAULT_RATE)).alias("rate_limit"),
            F.coalesce(F.try_element_at(weight_list, i + 1), F.lit(DEFAULT_WEIGHT)).alias("weight"),
            n_keys.alias("n_keys"))

    some = (urls_text != "") | (keys_text != "")
    return F.when(some, F.transform(base, entry))


def explode_endpoints(df: DataFrame, urls="urls", keys="keys", rates="rates", weights="weights") -> DataFrame:
    """One row per endpoint of each settings row."""
    rest = [c for c in df.columns if c not in (urls, keys, rates, weights)]
    return df.select(*rest, F.inline(endpoint_lists(urls, keys, rates, weights)))


def endpoints_from_config(spark: SparkSession, urls: str | None = None, keys: str | None = None,
                          rates: str | None = None, weights: str | None = None) -> DataFrame:
    """Endpoint dimension from four settings; only the number of keys enters the table."""
    n_keys = len([k for k in (keys or "").split(",") if k.strip()])
    # Key texts are counted here and replaced, so no secret reaches a plan.
    shadow = ",".join("k" for _ in range(n_keys))
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(n) for n, v in (
        ("urls", urls), ("keys", shadow), ("rates", rates), ("weights", weights))])
    return explode_endpoints(row)


def single_endpoint(spark: SparkSession, url: str | None = None, key: str | None = None, rate: int = 0) -> DataFrame:
    """One endpoint when a key or a URL is set, else none."""
    rows = [(0, url or None, rate, DEFAULT_WEIGHT, 1 if key else 0)] if url or key else []
    return spark.createDataFrame(rows, ENDPOINT_SCHEMA)
