"""Whitespace and JSON helpers shared by the other column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_JSON_END = "\x02end-of-value\x02"


def col_of(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(value) -> Column:
    """Trim every Unicode whitespace character; Spark's own trim takes spaces only."""
    return F.btrim(col_of(value), F.lit(WHITESPACE))


def blank_to_null(value) -> Column:
    stripped = strip(value)
    return F.when(stripped != "", stripped)


def strict_json(value) -> Column:
    """VARIANT of a complete JSON text, null when malformed or followed by anything else.

    ``try_parse_json`` stops after the first value, so the text is read as the
    first item of a two-item array whose second item must survive.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), col_of(value), F.lit(f',"{_escape(_JSON_END)}"]')))
    items = wrapped.cast("array<variant>")
    complete = (F.size(items) == 2) & (F.try_variant_get(wrapped, "$[1]", "string") == _JSON_END)
    return F.when(complete, F.try_variant_get(wrapped, "$[0]", "variant"))


def _escape(text: str) -> str:
    return "".join(f"\\u{ord(c):04x}" if ord(c) < 32 else c for c in text)


def preview(value, n: int = 100) -> Column:
    """First ``n`` characters plus '...' when something was cut."""
    c = col_of(value)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def base64_line(value) -> Column:
    """Base64 on one line; Spark's base64 may break lines at 76 characters."""
    return F.translate(F.base64(col_of(value)), "\r\n", "")


def lenient_base64(value) -> Column:
    """Decode base64, ignoring characters outside the alphabet; null when undecodable."""
    clean = F.regexp_replace(col_of(value), "[^A-Za-z0-9+/=]", "")
    # Unpadded input is an error for the reference behaviour, so it is one here.
    return F.when(F.length(clean) % 4 == 0, F.try_to_binary(clean, F.lit("base64")))
