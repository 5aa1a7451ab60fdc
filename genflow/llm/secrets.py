"""Secret scans over an incremental ledger of blobs.

Every historical version of a file is a row. Its text is content-addressed, so
equal texts are one blob. Only (blob, rule version) pairs the ledger has not
seen are scanned; findings are joined back to every path that held the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import whole

#: Changes whenever a rule does: old ledger rows then no longer count as scanned.
RULES_VERSION = "2"

# The base kinds, in the order they are listed in results.
BASE_KINDS = ("assign", "access", "hex")
# Kinds this scanner adds, with their patterns.
ADDED = {
    "pem": r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "forge": r"(?:ghp|gho|ghs|ghu|ghr|glpat|npm|pypi)[_-][A-Za-z0-9_-]{20,}",
    "chat": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "url_login": r"[a-z][a-z0-9+.]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@",
}
KINDS = (*BASE_KINDS, *ADDED)

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
# A shorter run fails whole, so asking for the length at once gives the same spans.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}", re.ASCII)
_HEX = re.compile(r"[0-9a-f]{24,}", re.ASCII)
# A text without one of these pairs has no assignment: two plain passes are cheaper than the pattern.
_HINT = re.compile(r"[dDtTnNyY][\"']?\x20*[:=]", re.ASCII)
_ADDED = {kind: re.compile(pattern, re.ASCII) for kind, pattern in ADDED.items()}
# What a text must hold for the added pattern to be worth a pass.
_ADDED_HINTS = {"pem": ("-----BEGIN ",), "jwt": ("eyJ",), "chat": ("xox",), "url_login": ("://",),
                "forge": ("ghp", "gho", "ghs", "ghu", "ghr", "glpat", "npm", "pypi")}

#: What stands in a redacted text for a secret.
MARK = "[SECRET]"
SPANS = "spans array<struct<kind:string,start:int,end:int>>"


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each finding, by start, then kind as listed; code points, end exclusive."""
    found = []
    if _HINT.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    for kind, pattern in _ADDED.items():
        if any(hint in text for hint in _ADDED_HINTS[kind]):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for a, b, k in find_spans(t.as_py())] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["blob", "spans"])


def address(text: str = "text"):
    """SHA-256 of the text's bytes (null: the empty text)."""
    return F.unhex(F.sha2(whole(text).cast("binary"), 256))


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """``versions`` with ``blob``, its text's address."""
    return versions.withColumn("blob", address(text))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, path: Sequence[str] = ("doc_id",),
                text: str = "text", rules_version: str = RULES_VERSION) -> DataFrame:
    """Ledger rows for blobs not yet scanned under ``rules_version``: (blob, rules_version, spans).

    One version per blob, the smallest path, is chosen from keys alone; its
    text moves to the scan, all others stay. If only a few are new, Spark
    broadcasts the chosen keys after checking their size and no text is moved.
    Repeated rows give one ledger row; an empty table gives none.
    """
    keyed = addressed(versions.select(*path, text), text)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(path)])
    blobs = keyed.select("blob", key.alias("_key")).groupBy("blob").agg(F.min("_key").alias("_key"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rules_version") == rules_version).select("blob"), "blob", "left_anti")
    chosen = blobs.select(F.col("blob").alias("_blob"), *[F.col(f"_key.k{i}").alias(f"_p{i}") for i in range(len(path))])
    match = [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(path)]
    texts = versions.select(*path, whole(text).alias("_text"))
    # The blob comes with the chosen key; a repeated path with another text is told apart by its own address.
    picked = texts.join(chosen, match).where(address("_text") == F.col("_blob"))
    found = picked.select(F.col("_blob").alias("blob"), "_text").mapInArrow(_scan, f"blob binary, {SPANS}")
    return found.dropDuplicates(["blob"]).withColumn("rules_version", F.lit(rules_version))


def findings_by_path(versions: DataFrame, ledger: DataFrame, path: Sequence[str] = ("doc_id",), text: str = "text",
                     rules_version: str = RULES_VERSION) -> DataFrame:
    """Every version row's path with the spans the ledger holds for its blob (``path``, blob, spans).

    Only blobs with findings are looked up; a path whose text is clean has an
    empty list. Adaptive execution splits a blob that owns many paths.
    """
    hits = ledger.where((F.col("rules_version") == rules_version) & (F.size("spans") > 0)).select("blob", "spans")
    keyed = addressed(versions.select(*path, text), text).select(*path, "blob")
    empty = F.lit([]).cast(hits.schema["spans"].dataType)
    return keyed.join(hits, "blob", "left").select(*path, "blob", F.coalesce("spans", empty).alias("spans"))


def masked(text: str, spans, mark: str = MARK) -> str:
    """``text`` with each (start, end) replaced by ``mark``; overlapping spans become one."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(text, spans, mark: str = MARK):
    """``text`` (column) with each span replaced by ``mark``; overlapping spans become one.

    A null text stays null; null or no spans leave the text as it is. Only
    texts with spans leave the JVM, and each is cut up once, so work is in
    proportion to the text and its spans.
    """
    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else masked(t, [(s["start"], s["end"]) for s in spans], mark) for t, spans in zip(texts, found)], dtype=object)

    some = F.coalesce(F.size(spans) > 0, F.lit(False))
    # Null arguments for the others keep their texts out of the transfer.
    return F.when(some, cut(F.when(some, text), F.when(some, spans))).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the base spans and all spans, as text, for each path row; zeros and empty texts without spans."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
