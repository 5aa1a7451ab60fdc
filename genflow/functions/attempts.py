"""Endpoint URLs, weights and retry waits as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .text import col_of, strip

# API version suffixes dropped from a base URL, in match order.
VERSION_SUFFIXES = ("/v1beta", "/v1alpha", "/v1")
MAX_WEIGHT_HALVINGS = 4


@dataclass(frozen=True)
class RetryPolicy:
    """Retries after the first try, with a capped exponential wait in seconds."""

    retries: int = 0
    delay: float = 1.0
    backoff: float = 2.0
    cap: float = 60.0

    @property
    def attempts(self) -> int:
        return max(1, self.retries + 1)

    def wait(self, attempt: int) -> float:
        """Wait after 0-based ``attempt`` failed; the last attempt does not wait."""
        return min(self.delay * self.backoff**attempt, self.cap) if attempt < self.retries else 0.0


# Rewriting services get three tries, one second apart, and no
# wait when only the reply was unreadable.
REWRITE_POLICY = RetryPolicy(retries=2, delay=1.0, backoff=1.0, cap=1.0)


def retry_wait(attempt, policy: RetryPolicy) -> Column:
    """Seconds to wait after 0-based ``attempt``."""
    attempt = col_of(attempt)
    wait = F.least(F.lit(policy.delay) * F.pow(F.lit(policy.backoff), attempt), F.lit(policy.cap))
    return F.when(attempt < policy.retries, wait).otherwise(F.lit(0.0))


def normalize_base_url(url, version=None) -> Column:
    """STRUCT<url,version>: trailing slashes and one version suffix dropped.

    The suffix gives the version only when none was stated.
    """
    url = col_of(url)
    version = F.lit(None).cast("string") if version is None else col_of(version)
    trimmed = F.regexp_replace(strip(url), "/+$", "")
    suffix = F.coalesce(*[F.when(trimmed.endswith(s), F.lit(s)) for s in VERSION_SUFFIXES], F.lit(""))
    base = F.substring(trimmed, F.lit(1), F.length(trimmed) - F.length(suffix))
    given = F.coalesce(url, F.lit("")) != ""
    inferred = F.coalesce(version, F.nullif(F.substring(suffix, 2, 20), F.lit("")))
    return F.struct(
        F.when(given, base).alias("url"),
        F.when(given, inferred).otherwise(version).alias("version"))


def effective_weight(weight, errors) -> Column:
    """Weight after halving once per outstanding error (four at most), never below 1."""
    weight, errors = col_of(weight), col_of(errors)
    halvings = F.least(errors, F.lit(MAX_WEIGHT_HALVINGS).cast("bigint"))
    reduced = F.floor(weight / F.pow(F.lit(2.0), halvings)).cast("bigint")
    return F.when(errors > 0, F.greatest(F.lit(1).cast("bigint"), reduced)).otherwise(weight.cast("bigint"))


def hash_draw(key, total) -> Column:
    """Repeatable draw in [0, total) from the first 32 bits of md5(key)."""
    bits = F.conv(F.substring(F.md5(col_of(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(bits, F.lit(total) if isinstance(total, int) else col_of(total))
