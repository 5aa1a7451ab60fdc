"""What the operators share: shared-folder tables, text batches, word hashes, components."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..shipping import ship
from ..storage import shared_folder

# Fixed values of the word hash: an odd base for the polynomial, and splitmix64's constants.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that one numpy pass works on; a longer text is still taken whole.
PIECE_BYTES = 1 << 21

_SCRATCH: dict[str, SparkSession] = {}


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own in the shared one, deleted with the scratch tables."""
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    _SCRATCH[path] = spark
    return path


def scratch(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later steps, retries and lost executors read the files. They go when
    :func:`drop_scratch` is called or the driver's Python ends.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame | None = None) -> None:
    """Delete the scratch table behind ``df``, or all of them once their readers are done."""
    wanted = None if df is None else {re.sub(r"(/[^/=]+=[^/]*)*/[^/]*$", "", f) for f in df.inputFiles()}
    for path in list(_SCRATCH):
        if wanted is not None and not any(w.endswith(path.split(":")[-1].lstrip("/")) for w in wanted):
            continue
        spark = _SCRATCH.pop(path)
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended: its shared folder is the user's to empty
            return


atexit.register(drop_scratch)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole(text: str | Column = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many marks in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each text starts (one more entry: the end)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher: spreads the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def stream(x: np.ndarray, i: int) -> np.ndarray:
    """The i-th pseudo-random 64-bit number that belongs to each x."""
    return mix(x + np.uint64((int(_STEP) * (i + 1)) % 2**64))


def _inverse(base: int) -> int:
    return pow(base, -1, 2**64)


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
#: Bytes other than space, tab and the line ends 10 to 13.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_CACHE: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("pow", ())) < n:
        size = max(n, PIECE_BYTES // 2)
        _CACHE["pow"] = _powers(_BASE, size)
        _CACHE["inv"] = _powers(np.uint64(_inverse(int(_BASE))), size)
    return _CACHE["pow"], _CACHE["inv"]


def words(raw: np.ndarray, starts: np.ndarray, is_word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word in the bytes, in order.

    A word is a longest run where ``is_word`` holds within one text; by default
    of ASCII letters and digits and of all non-ASCII bytes. Vectorised: a word's
    hash is a difference of prefix sums of byte times power of a base.
    """
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    is_word = _WORD[raw] if is_word is None else is_word
    edge = np.empty(len(raw), bool)
    edge[0] = is_word[0]
    np.greater(is_word[1:], is_word[:-1], out=edge[1:])
    inner = starts[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    edge[inner] |= is_word[inner]
    begin = np.flatnonzero(edge)
    last = np.empty(len(raw), bool)
    last[-1] = is_word[-1]
    np.greater(is_word[:-1], is_word[1:], out=last[:-1])
    last[inner - 1] |= is_word[inner - 1]
    end = np.flatnonzero(last) + 1
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):  # pieces of whole words bound the temporary arrays
        stop = max(at + 1, int(np.searchsorted(end, begin[at] + PIECE_BYTES // 2, "right")))
        low, high = begin[at], end[stop - 1]
        power, inverse = _tables(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * power[:high - low], out=sums[1:])
        b, e = begin[at:stop] - low, end[at:stop] - low
        out[at:stop] = (sums[e] - sums[b]) * inverse[b] + (e - b).astype(np.uint64)
        at = stop
    return begin, end, mix(out)


def word_runs(raw: np.ndarray, starts: np.ndarray, is_word: np.ndarray | None = None):
    """:func:`words`, and where each text's words start among them."""
    begin, end, hashes = words(raw, starts, is_word)
    return begin, end, hashes, np.searchsorted(begin, starts)


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` words inside one text, and the text it is in.

    A text of fewer words, but one at least, has one run: all its words.
    """
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    total = len(hashes)
    if total >= n:
        out = np.zeros(total - n + 1, np.uint64)
        for t in range(n):
            out = out * _BASE + hashes[t:total - n + 1 + t]
        inside = text_of[:total - n + 1] == text_of[n - 1:]
        out, owner = mix(out[inside]), text_of[:total - n + 1][inside]
    else:
        out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short):
            for h in hashes[first[d]:first[d + 1]]:
                extra[i] = (int(extra[i]) * int(_BASE) + int(h)) % 2**64
            extra[i] = (int(extra[i]) + int(counts[d])) % 2**64
        out, owner = np.concatenate([out, mix(extra)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node each linked node can reach: rows ``(node, component)``.

    Each round every node joins its neighbour of lowest hash, if that is lower
    than its own, and links inside what was joined go; the hash changes with
    the round, so the links left shrink by a share each time, chains and stars
    alike. A node linked only with itself is its own component.
    """
    edges = scratch(
        links.select(F.col(a).alias("x"), F.col(b).alias("y"))
        .unionByName(links.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), "edges")
    names = scratch(edges.select(F.col("x").alias("node"), F.col("x").alias("label")).distinct(), "labels")
    edges = edges.where("x <> y")
    round_ = 0
    while edges.limit(1).count():
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(round_)).alias("h"), F.col(c).alias("node"))  # noqa: B023, E731
        parents = scratch(edges.groupBy("x").agg(F.least(rank("x"), F.min(rank("y")))["node"].alias("p")), "parents")
        new = (edges.join(parents, "x").select("y", F.col("p").alias("px"))
               .join(parents.select(F.col("x").alias("y"), F.col("p").alias("py")), "y").where("px <> py")
               .select(F.col("px").alias("x"), F.col("py").alias("y")).distinct())
        new = scratch(new, "edges")
        moved = scratch(names.join(parents.withColumnRenamed("x", "label"), "label", "left").select(
            "node", F.coalesce("p", "label").alias("label")), "labels")
        for done in (edges, parents, names):
            drop_scratch(done)
        edges, names, round_ = new, moved, round_ + 1
    low = names.groupBy("label").agg(F.min("node").alias("component"))
    return names.join(low, "label").select("node", "component")
