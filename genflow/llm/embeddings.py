"""Near-duplicate embeddings by collision counts over sorted projections.

Unit vectors are projected on many random lines. A pair at the cosine limit
lies within a window on nearly all lines, a distant pair on few. Vectors are
sorted by one line and cut into blocks; block pairs within reach count how
often each pair collides on the other lines, and pairs with enough collisions
are verified in double precision.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.order import positions
from .common import components, drop_scratch, scratch
from .sharding import _numbered

COSINE = 0.98
LINES, SEED = 32, 20240229
#: Half a window, in standard deviations of a limit pair's difference on a line; and the reach of blocks on the first line.
WINDOW, REACH = 2.0, 5.0
#: Wanted chance that a pair at the limit has enough collisions.
RECALL = 0.9999
BLOCK = 1024
#: Lines that all pairs of two blocks are counted on; the rest only sees pairs that can still pass.
DENSE_LINES = 12


def calibrated(lines: int = LINES, window: float = WINDOW, recall: float = RECALL) -> int:
    """Most collisions to ask for so that a pair at the limit passes with chance ``recall``."""
    p = erf(window / sqrt(2))
    total = 0.0
    for count in range(lines, -1, -1):
        total += comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if total >= recall:
            return count
    return 0


def directions(size: int, lines: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, lines))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by their largest entry, so no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def _first_line(batches):
    for batch in batches:
        if batch.num_rows:
            size = np.asarray(batch.column("size"))
            out = np.zeros(batch.num_rows)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                out[at] = unit(_matrix(batch.column("vec").take(pa.array(at)))) @ directions(int(d), LINES)[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out)], names=["node", "line"])


def colliding(left: np.ndarray, right: np.ndarray, need: int, window: float, dense: int = DENSE_LINES) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two projection tables (rows x lines) with ``need`` collisions at least.

    A row's window on a line is a run of the other side's sorted values. On the
    dense lines runs are added up for all pairs; a pair with more misses than
    it may have is then left out of the other lines.
    """
    lines = left.shape[1]
    hits = np.zeros((len(left), len(right)), np.int8)
    for j in range(min(dense, lines)):
        order = np.argsort(right[:, j], kind="stable")
        values = right[order, j]
        low = np.searchsorted(values, left[:, j] - window, "left")
        high = np.searchsorted(values, left[:, j] + window, "right")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        hits += (rank >= low[:, None]) & (rank < high[:, None])
    a, b = np.nonzero(hits >= need - (lines - min(dense, lines)))
    count = hits[a, b].astype(np.int64)
    for j in range(dense, lines):
        count += np.abs(left[a, j] - right[b, j]) <= window
        can = count >= need - (lines - 1 - j)
        a, b, count = a[can], b[can], count[can]
    return a, b


def _compare(cosine: float, lines: int, window: float, need: int):
    half = window * sqrt(2 * (1 - cosine))

    def run(table: pa.Table) -> pa.Table:
        """Of two blocks (or one with itself): each node's linked weight, and a forest of the links."""
        node, weight, side = (np.asarray(table.column(c)) for c in ("node", "copies", "side"))
        order = np.lexsort((node, side))
        vectors = unit(_matrix(table.column("vec")))[order]
        node, weight, side = node[order], weight[order], side[order]
        own = not (side == 1).any()
        cut = len(node) if own else int(np.searchsorted(side, 1))
        placed = vectors @ directions(vectors.shape[1], lines)
        left, right = slice(0, cut), slice(0, len(node)) if own else slice(cut, len(node))
        a, b = colliding(placed[left], placed[right], need, half)
        b = b + (0 if own else cut)
        if own:
            a, b = a[a < b], b[a < b]
        sure = np.zeros(len(a), bool)
        for i in range(0, len(a), 1 << 16):
            part = slice(i, i + (1 << 16))
            sure[part] = np.einsum("ij,ij->i", vectors[a[part]], vectors[b[part]]) >= cosine
        a, b = a[sure], b[sure]
        linked = np.bincount(a, weights=weight[b], minlength=len(node)) + np.bincount(b, weights=weight[a], minlength=len(node))
        root = np.arange(len(node))
        while True:  # smallest label over links, then labels of labels
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(linked > 0)
        return pa.table({"node": node[some], "root": node[root[some]], "linked": linked[some].astype(np.int64)})
    return run


def usable(vec: Column) -> Column:
    """Whether a vector has entries, all of them finite, and one that is not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def linked_vectors(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
                   cosine: float = COSINE, lines: int = LINES, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``(vec_id, n_links, component_id, kept)``.

    Vectors link if their labels are equal and not null, their lengths are
    equal and their cosine in double precision is at least ``cosine``. A vector
    that is null, empty, zero, or holds null or non-finite entries links with
    nothing. ``n_links`` counts other rows, equal ones included; a null id
    never names a component unless all its rows are null. An empty table
    gives no rows; other columns are not carried.

    Equal vectors of a label are one node with a weight. Blocks hold ``block``
    nodes; a task compares two blocks and returns a row per node, so neither a
    hot label nor a large group meets in one task or is spelled out as pairs.
    """
    rows = _numbered(scratch(vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                                            F.col(vec).cast("array<double>").alias("vec")), "vectors"))
    good = F.col("label").isNotNull() & usable(F.col("vec"))
    # Rows of equal vectors come together as hash and count; the vector itself is fetched for one of them.
    keyed = rows.where(good).select("vec_id", "nid", "label", F.size("vec").alias("size"), F.xxhash64("vec").alias("h1"),
                                    F.hash("vec").alias("h2"))
    group = ["label", "size", "h1", "h2"]
    lowest = F.min(F.struct(F.col("vec_id").isNull().alias("last"), "vec_id"))["vec_id"]
    nodes = scratch(keyed.groupBy(*group).agg(F.min("nid").alias("node"), F.count(F.lit(1)).alias("copies"), lowest.alias("low")), "nodes")
    points = scratch(rows.select(F.col("nid").alias("node"), "vec").join(nodes.select("node", "label", "size", "copies"), "node"), "points")
    line = points.mapInArrow(_first_line, "node bigint, line double")
    ranked = positions(line.join(points.select("node", "label", "size"), "node"), ["line", "node"], ["label", "size"], "pos")
    placed = scratch(ranked.select("node", "line", "label", "size", F.floor(F.col("pos") / block).cast("int").alias("block")), "placed")
    spans = scratch(placed.groupBy("label", "size", "block").agg(F.min("line").alias("low"), F.max("line").alias("high")), "spans")
    reach = REACH * sqrt(2 * (1 - cosine))
    x, y = spans.alias("x"), spans.alias("y")
    near = (F.col("x.label") == F.col("y.label")) & (F.col("x.size") == F.col("y.size")) & (
        F.col("x.block") <= F.col("y.block")) & (F.col("y.low") - F.col("x.high") <= reach)
    pairs = x.join(y, near).select("x.label", "x.size", F.col("x.block").alias("one"), F.col("y.block").alias("two"))
    sides = scratch(pairs.select("label", "size", "one", "two", F.explode(F.expr(
        "case when one = two then array(named_struct('side', 0, 'block', one)) "
        "else array(named_struct('side', 0, 'block', one), named_struct('side', 1, 'block', two)) end")).alias("s")).select(
        "label", "size", "one", "two", "s.side", "s.block"), "sides")
    members = scratch(points.join(placed.select("node", "block"), "node"), "members")
    sent = members.join(sides, ["label", "size", "block"]).select("label", "size", "one", "two", "side", "node", "copies", "vec")
    need = calibrated(lines)
    found = scratch(sent.groupBy("label", "size", "one", "two").applyInArrow(
        _compare(cosine, lines, WINDOW, need), "node bigint, root bigint, linked bigint"), "found")
    for done in (points, placed, members):
        drop_scratch(done)
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    whole_ = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = whole_.groupBy("component").agg(F.min("low").alias("component_id"))
    final = scratch(whole_.join(names, "component").join(counts, "node", "left").select(
        *group, "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "final")
    hashed = rows.select("vec_id", F.when(good, F.col("label")).alias("label"), F.size("vec").alias("size"),
                         F.xxhash64("vec").alias("h1"), F.hash("vec").alias("h2"))
    out = hashed.join(final, group, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
