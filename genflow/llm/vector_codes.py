"""Compressed vectors: product codes by Lloyd rounds whose members stay with their owner.

A vector becomes integers and is cut into parts. The parts of one position are
clustered around that position's entries. A part lives in the files of its
owner (position, entry, salt): each round the owners add up the members they
hold, the small codebook is rebuilt from those sums, and every part is assigned
where it lies. Only parts whose entry changed are shuffled, to their new
owner's files; the others stay in the files their task has written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import drop_scratch, scratch, scratch_folder

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Parts that a salt of an entry would hold if all entries were alike; and the fewest salts.
OWNER_ROWS, LEAST_SALTS = 4096, 16
#: Components beyond this, and errors beyond the second, are held at it.
LARGEST, LARGEST_ERROR = 2**62, 2**63 - 1
#: Components that one numpy pass works on.
CELLS = 1 << 20

_PART = "nid bigint, position int, entry int, salt int, moved boolean, part array<bigint>"


@dataclass(frozen=True)
class Codebooks:
    """Integer components of every entry, by position: ``entries[position][entry]`` is a tuple."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]
    width: int

    @property
    def sha256(self) -> str:
        """Lowercase hex digest of all components by position, entry and place, comma-joined."""
        listed = (str(x) for position in self.entries for entry in position for x in entry)
        return hashlib.sha256(",".join(listed).encode()).hexdigest()


def usable(vec: Column) -> Column:
    """Whether a vector is not null and all its components are finite numbers."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def integers(column: pa.Array, size: int, scale: int = SCALE) -> np.ndarray:
    """Each vector's components as floor(scale * x), shorter vectors with zeros up to ``size``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int64)
    if (lengths == size).all():
        return flat.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def nearest(parts: np.ndarray, entries: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, the lower one in a tie, and the squared distance.

    Exact: where a sum could leave 64 bits, Python's integers are used.
    """
    n, width = parts.shape
    most = max([int(np.abs(parts).max()) if parts.size else 0, *(abs(x) for entry in entries for x in entry)])
    kind = np.int64 if width * (2 * most) ** 2 < 2**63 else object
    parts = parts.astype(kind)
    best, index = None, np.zeros(n, np.int32)
    for k, entry in enumerate(entries):
        away = parts - np.array(entry, kind).reshape(1, width)
        far = (away * away).sum(axis=1) if width else np.zeros(n, kind)
        if best is None:
            best = far
        else:
            closer = far < best
            index[closer], best = k, np.where(closer, far, best)
    return index, best


def _slices(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, CELLS // max(1, cells))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _part_batch(nid, position, entry, salt, moved, part) -> pa.RecordBatch:
    n, width = part.shape
    listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(part.reshape(-1)))
    columns = [pa.array(nid, pa.int64()), *(pa.array(x, pa.int32()) for x in (position, entry, salt)), pa.array(moved), listed]
    return pa.RecordBatch.from_arrays(columns, names=["nid", "position", "entry", "salt", "moved", "part"])


def _dealt(books: Codebooks, salts: int):
    """Vectors cut into parts, each with its first owner."""
    def run(batches):
        for batch in _slices(batches, PARTS * books.width):
            whole = integers(batch.column("vec"), PARTS * books.width)
            nid = np.asarray(batch.column("nid"))
            salt = (nid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % salts
            for p, entries in enumerate(books.entries):
                part = whole[:, p * books.width:(p + 1) * books.width]
                index, _ = nearest(part, entries)
                yield _part_batch(nid, np.full(len(nid), p), index, salt, np.ones(len(nid), bool), np.ascontiguousarray(part))
    return run


def _grouped(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    part = batch.column("part").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, width)
    return np.asarray(batch.column("position")), np.asarray(batch.column("entry")), part


def _sums(width: int):
    """Of the members in a task: for each owner's position and entry their number (place -1) and the sum of each component."""
    def run(batches):
        for batch in _slices(batches, width):
            position, entry, part = _grouped(batch, width)
            owner = position.astype(np.int64) * ENTRIES_LIMIT + entry
            order = np.argsort(owner, kind="stable")
            begin = np.flatnonzero(np.diff(owner[order], prepend=-1))
            count = np.diff(np.append(begin, len(order)))
            safe = part.size == 0 or int(np.abs(part).max()) * len(part) < 2**63
            sums = np.add.reduceat(part[order].astype(np.int64 if safe else object), begin, axis=0)
            rows = [(int(o) // ENTRIES_LIMIT, int(o) % ENTRIES_LIMIT, place, str(value))
                    for o, n, line in zip(owner[order][begin], count, sums)
                    for place, value in enumerate([int(n), *line.tolist()], -1)]
            p, e, place, value = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(place, pa.int32()), pa.array(value)],
                                             names=["position", "entry", "place", "value"])
    return run


#: More than any number of entries.
ENTRIES_LIMIT = 1 << 20


def _moved(books: Codebooks):
    """Members assigned anew where they lie; ``moved`` marks those whose entry changed."""
    def run(batches):
        for batch in _slices(batches, books.width):
            position, entry, part = _grouped(batch, books.width)
            index = np.zeros(len(entry), np.int32)
            for p in np.unique(position):
                mine = np.flatnonzero(position == p)
                index[mine], _ = nearest(part[mine], books.entries[p])
            yield _part_batch(np.asarray(batch.column("nid")), position, index, np.asarray(batch.column("salt")), index != entry, part)
    return run


def _settled(parts: DataFrame) -> DataFrame:
    """Parts in their owners' files after one shuffle of those that moved; all others stay in the files just written."""
    spark = parts.sparkSession
    path = scratch_folder(spark, "parts")
    parts.write.partitionBy("moved").parquet(path)
    written = spark.read.schema(_PART).parquet(path)
    owner = ["position", "entry", "salt"]
    arrived = scratch(written.where("moved").repartition(*owner).sortWithinPartitions(*owner), "arrived")
    return written.where("not moved").unionByName(arrived)


def _updated(books: Codebooks, residents: DataFrame) -> Codebooks:
    """Each entry replaced by the floor of its members' mean; entries without members stay."""
    sums = residents.mapInArrow(_sums(books.width), "position int, entry int, place int, value string")
    total = sums.groupBy("position", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
    held: dict[tuple[int, int], dict[int, int]] = {}
    for row in total.collect():  # as many rows as the codebooks have components and entries
        held.setdefault((row["position"], row["entry"]), {})[row["place"]] = int(row["total"])
    return Codebooks(tuple(
        tuple(tuple(held[p, e][i] // held[p, e][-1] for i in range(books.width)) if (p, e) in held else entry
              for e, entry in enumerate(position))
        for p, position in enumerate(books.entries)), books.width)


def first_codebooks(vectors: DataFrame, entries: int = ENTRIES) -> Codebooks:
    """The parts of the ``entries`` rows of smallest ``vec_id`` (equal ids by vector, null ids last) of a table of usable vectors."""
    longest = vectors.agg(F.max(F.size("vec")).alias("n")).first()["n"] or 0
    width = -(-longest // PARTS)
    lowest = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("vec").limit(entries).collect()
    whole = integers(pa.array([r["vec"] for r in lowest], pa.list_(pa.float64())), PARTS * width).tolist()
    return Codebooks(tuple(tuple(tuple(v[p * width:(p + 1) * width]) for v in whole) for p in range(PARTS)), width)


def fit(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` Lloyd rounds over every row of a stored table ``(nid, vec_id, vec)`` of usable vectors.

    Ends early only where a round leaves the codebooks as they were, as all
    later rounds would. An empty table gives codebooks without entries.
    """
    books = first_codebooks(vectors, entries)
    if not books.entries[0] or not rounds:
        return books
    salts = max(LEAST_SALTS, vectors.count() // OWNER_ROWS)
    residents = _settled(vectors.select("nid", "vec").mapInArrow(_dealt(books, salts), _PART))
    for done in range(1, rounds + 1):
        new = _updated(books, residents)
        if new == books:
            break
        books = new
        if done < rounds:
            before, residents = residents, _settled(residents.mapInArrow(_moved(books), _PART))
            drop_scratch(before)
    drop_scratch(residents)
    return books


def encode(vectors: DataFrame, books: Codebooks, schema: str) -> DataFrame:
    """``vec_id`` and ``label`` of usable vectors with ``code`` and ``error``; no row leaves its task. ``schema``: that of the result."""
    size = PARTS * books.width

    def run(batches):
        digits = np.array([f"{i:02x}" for i in range(max(1, len(books.entries[0])))])
        for batch in _slices(batches, size):
            whole = integers(batch.column("vec"), size)
            found = [nearest(whole[:, p * books.width:(p + 1) * books.width], entries) for p, entries in enumerate(books.entries)]
            code = digits[found[0][0]]
            for index, _ in found[1:]:
                code = np.char.add(code, digits[index])
            error = [min(sum(each), LARGEST_ERROR) for each in zip(*(far.tolist() for _, far in found))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code.tolist(), pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "vec").mapInArrow(run, schema)


def compressed(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
               entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: ``(vec_id, code, error, label_error, codebooks_sha256)``.

    Rows whose vector is null or holds a null or non-finite component are left
    out; a vector of zeros is a vector like any other. All rows are whole and
    all are learned from. Vectors are as long as the longest one, rounded up to
    a multiple of eight: shorter ones, empty ones too, go on with zeros.
    Repeated rows count as often as they occur. Ties go to the lower entry.
    Equal ids are ordered by their vectors, null ids come last. Fewer usable
    rows than entries give as many entries as rows; an empty table gives no
    rows. ``label_error`` sums over equal labels, null being one. Components
    beyond 2^62 and errors beyond 2^63 - 1 are held at these. Other columns are
    not carried, whatever their names.

    An entry that holds most parts is dealt over salts that grow with the
    table, so no owner is much larger than others; of a task's members only one
    sum per entry and component leaves it.
    """
    from .sharding import _numbered

    picked = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("vec"))
    kept = _numbered(scratch(picked.where(usable(F.col("vec"))), "vectors"))
    books = fit(kept, entries, rounds)
    types = {f.name: f.dataType.simpleString() for f in picked.schema}
    coded = scratch(encode(kept, books, f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint"), "codes")
    drop_scratch(kept)
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("_of")).agg(F.least(exact, F.lit(LARGEST_ERROR)).cast("bigint").alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def _oracle() -> str:
    steps = [f"""
kept as (select row_number() over (order by vec_id nulls last, embedding) as rid, vec_id, label,
        list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (select rid, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] as v from kept, range({PARTS}) r(p)),
book0 as materialized (select p, rid - 1 as e, v from parts where rid <= {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
near{r} as materialized (select rid, p, min(d).e as e, min(d).d as d from (
        select a.rid, a.p, {{'d': list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.e}} as d
        from parts a join book{r} b on a.p = b.p) group by rid, p)""")
        if r < ROUNDS:
            steps.append(f"""
mean{r} as (select p, e, list(m order by i) as v from (
        select n.p, n.e, i, floor(sum(a.v[i]) / count(*))::bigint as m
        from near{r} n join parts a on a.rid = n.rid and a.p = n.p, range(1, len(a.v) + 1) s(i) group by n.p, n.e, i) group by p, e),
book{r + 1} as materialized (select b.p, b.e, coalesce(m.v, b.v) as v from book{r} b left join mean{r} m on b.p = m.p and b.e = m.e)""")
    return "with " + ",".join(steps) + f""",
coded as (select rid, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from near{ROUNDS} group by rid),
books as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as h from book{ROUNDS})
select k.vec_id, c.code, c.error, sum(c.error) over (partition by k.label)::bigint as label_error, h as codebooks_sha256
from kept k join coded c on k.rid = c.rid, books"""


ORACLE = _oracle()
