"""Prefix trie of conversations, with subtree totals by centroid decomposition.

Every distinct run of first turns is a node, named by the exclusive or of
128-bit hashes of (depth, role, text), so names need no walk along a
conversation. The trie's parent edges form components that are split at
weighted centroids: a centroid's total inside its component is added along the
path from the centroid to the component's top, then the component falls apart
into the centroid's child components and what is above. Components over a bound
are split by Spark joins; smaller ones are split many at a time inside tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.order import positions
from .common import drop_scratch, scratch

FAMILY, MOST_SHARED = 20, 4
#: Turns of equal number and role go by so many characters of their texts, then by the texts' hashes.
TIE_CHARS = 64
#: Turns of a conversation that one window runs over.
BLOCK = 4096
#: Weight up to which a component is split inside a task; and rows of components that one pass takes together.
LOCAL_WEIGHT, PASS_ROWS = 2048, 1 << 16
#: Ids of one node that are joined into a piece of text before it is hashed.
PIECE_IDS = 8192
#: The values that are rolled up, besides the weight.
VALUES = ("leaves", "tokens")


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("bigint")


def _words(text: Column) -> Column:
    """Number of runs of anything but space, tab and the line ends 10 to 13."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``(conv_id, depth, h1, h2, words)`` and conversations ``(conv_id, len)``, turnless ones too.

    Texts are read once and go on as their hashes and number of words.
    """
    body, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    plain = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").isNotNull().alias("numbered"), "turn", role.alias("role"),
        F.xxhash64(role, body).alias("g1"), F.xxhash64(body, F.lit("|"), role).alias("g2"), _words(body).alias("words"), F.substring(body, 1, TIE_CHARS).alias("head"))
    order = ["numbered", "turn", "role", "head", "g1", "g2"]
    own = scratch(positions(plain, order, ["conv_id"], "pos").select("conv_id", "pos", "g1", "g2", "words"), "turns")
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), shared_turns(F.col("conv_id")).alias("h"))
    convs = scratch(convs, "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    lengths = scratch(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"),
        (F.least("h", F.coalesce("base_n", F.lit(0))) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "lengths")
    first = own.where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv_id", "base")
    given = lengths.select("conv_id", "base", "taken").join(first, "base").where("pos < taken").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "g1", "g2", "words")
    kept = own.join(lengths, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "g1", "g2", "words")
    placed = given.unionByName(kept)
    marked = placed.select("conv_id", "depth", F.xxhash64("depth", "g1", "g2").alias("h1"),
                           F.xxhash64("g2", "depth", "g1").alias("h2"), "words")
    return marked, lengths.select("conv_id", "len")


def paths(marked: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every node of every conversation: ``(conv_id, depth, k1, k2, p1, p2, words, len)``, the root at depth 0."""
    block = F.floor(F.col("depth") / BLOCK).cast("bigint")
    rows = marked.withColumn("block", block)
    totals = rows.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    carried = totals.select("conv_id", "block", *[F.coalesce(F.bit_xor(b).over(earlier), zero).alias(c) for b, c in (("b1", "c1"), ("b2", "c2"))])
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("*", F.bit_xor("h1").over(inside).alias("r1"), F.bit_xor("h2").over(inside).alias("r2"))
    named = run.join(carried, ["conv_id", "block"]).select(
        "conv_id", "depth", F.col("r1").bitwiseXOR(F.col("c1")).alias("k1"), F.col("r2").bitwiseXOR(F.col("c2")).alias("k2"), "h1", "h2", "words")
    named = named.join(lengths, "conv_id").select(
        "conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "words", "len")
    null = F.lit(None).cast("bigint")
    roots = lengths.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), null.alias("p1"), null.alias("p2"), zero.alias("words"), "len")
    return named.unionByName(roots)


def trie(path: DataFrame) -> DataFrame:
    """One row per node: ``(nid, depth, k1, k2, rep, n_convs, n_children, words, parent, parent_rep)``; ``rep`` is the smallest member."""
    from .sharding import _numbered

    grouped = path.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("p1").alias("p1"),
        F.max("p2").alias("p2"))
    nodes = _numbered(scratch(grouped, "nodes"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("nid").alias("parent"), F.col("rep").alias("parent_rep"))
    linked = nodes.join(above, ["depth", "p1", "p2"], "left")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    return linked.join(children, ["depth", "k1", "k2"], "left").select(
        "nid", "depth", "k1", "k2", "rep", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "words", "parent", "parent_rep")


def split(nid: np.ndarray, parent: np.ndarray, comp: np.ndarray, depth: np.ndarray, weight: np.ndarray,
          values: np.ndarray) -> np.ndarray:
    """Subtree totals inside each component of every node, by centroid decomposition of all components at once.

    ``parent`` is a place in the arrays, a component's top its own parent.
    ``weight`` is a subtree's weight inside the component, more than that of
    any subtree below. Each round a component's centroid is its deepest node
    with more than half of the weight.
    """
    n = len(nid)
    out = np.zeros((n, values.shape[1]), np.int64)
    weight, comp, up = weight.copy(), comp.copy(), parent.copy()
    open_ = np.arange(n)
    while len(open_):
        # Components get small numbers; the top of each is its own parent and has all its weight.
        _, of = np.unique(comp[open_], return_inverse=True)
        count = of.max() + 1
        whole = np.zeros(count, np.int64)
        np.maximum.at(whole, of, weight[open_])
        heavy = np.flatnonzero(2 * weight[open_] > whole[of])
        heavy = heavy[np.lexsort((depth[open_[heavy]], of[heavy]))]
        last = np.append(np.flatnonzero(np.diff(of[heavy])), len(heavy) - 1)
        centroid = open_[heavy[last]]  # one per component, in order
        mine = np.zeros(n, bool)
        mine[centroid] = True
        # Where each node hangs once the centroid is cut out: at the top, at the centroid, or at one of its children.
        hang = np.arange(n)
        hang[open_] = np.where(mine[open_] | mine[up[open_]], open_, up[open_])
        while True:
            further = hang[hang[open_]]
            if (further == hang[open_]).all():
                break
            hang[open_] = further
        at = hang[open_]
        below = mine[at] | (mine[up[at]] & (up[at] != at))
        total = np.zeros((count, values.shape[1]), np.int64)
        np.add.at(total, of[below], values[open_[below]])
        out[centroid] += total
        lost = weight[centroid]
        walk, owner = centroid, np.arange(count)
        while True:  # one step up for all components that still have a way to go
            go = up[walk] != walk
            walk, owner = up[walk[go]], owner[go]
            if not len(walk):
                break
            out[walk] += total[owner]
            weight[walk] -= lost[owner]
        comp[open_[below]] = -1 - at[below]  # a child component is named by its top
        tops = open_[below & (at == open_)]
        up[tops] = tops
        up[centroid] = centroid
        open_ = open_[~mine[open_]]
    return out


def _split_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, sorted by ``comp``, in passes of bounded size."""
    held: list[pa.RecordBatch] = []

    def passed(table: pa.Table):
        col = {c: table.column(c).to_numpy() for c in ("nid", "comp", "depth", "weight", *VALUES)}
        parent = table.column("parent").fill_null(-1).to_numpy()
        order = np.argsort(col["nid"])
        place = np.minimum(np.searchsorted(col["nid"], parent, sorter=order), len(order) - 1)
        at = order[place]
        inside = (col["nid"][at] == parent) & (col["comp"][at] == col["comp"])
        up = np.where(inside, at, np.arange(len(at)))
        _, comp = np.unique(col["comp"], return_inverse=True)
        sums = split(col["nid"], up, comp, col["depth"], col["weight"], np.stack([col[v] for v in VALUES], 1))
        return pa.RecordBatch.from_arrays([pa.array(col["nid"]), *(pa.array(sums[:, i]) for i in range(len(VALUES)))],
                                          names=["nid", *(f"in_{v}" for v in VALUES)])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= PASS_ROWS:
            table = pa.Table.from_batches(held)
            comp = table.column("comp").to_numpy()
            cut = int(np.searchsorted(comp, comp[-1]))
            if cut:
                yield passed(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield passed(pa.Table.from_batches(held))


def rolled_up(nodes: DataFrame, path: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """``(nid, sum_leaves, sum_tokens)``: totals of ``leaves`` and ``tokens`` over each node's subtree.

    ``nodes`` has ``nid, parent, depth, rep, leaves, tokens``; ``path`` has the node of each depth of each
    conversation that is some node's ``rep``: ``conv_id, depth, nid, child, len``. A node's weight is the number of
    such conversations through it, so a subtree's weight is a plain sum over ``path``, more than that of any subtree below.
    """
    weights = path.groupBy("nid").agg(F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    zero = F.lit(0).cast("bigint")
    start = nodes.join(weights, "nid").select(
        "nid", "parent", "depth", "rep", zero.alias("comp"), "weight", *VALUES, *[zero.alias(f"sum_{v}") for v in VALUES])
    state, done = scratch(start, "state"), None
    while True:
        tops = scratch(state.groupBy("comp").agg(F.max("weight").alias("whole"), F.min("depth").alias("top")).where(F.col("whole") > local_weight), "tops")
        if tops.isEmpty():
            break
        heavy = state.join(tops, "comp").where(2 * F.col("weight") > F.col("whole"))
        deepest = F.max_by(F.struct("nid", "rep", "depth", "weight"), "depth")
        cuts = scratch(heavy.groupBy("comp").agg(deepest.alias("c"), F.max("top").alias("top")).select(
            "comp", F.col("c.nid").alias("cut"), F.col("c.rep").alias("cut_rep"), F.col("c.depth").alias("cut_depth"),
            F.col("c.weight").alias("lost"), "top"), "cuts")
        # Conversations through each centroid, with its child on them; and the nodes above it, up to the component's top.
        through = path.join(cuts.select("comp", F.col("cut").alias("nid")), "nid").select(
            F.col("comp").alias("t_comp"), F.col("conv_id").alias("t_conv"), F.coalesce("child", F.lit(-1).cast("bigint")).alias("child"))
        above = path.join(cuts.select(F.col("cut_rep").alias("conv_id"), "cut_depth", "top"), "conv_id").where(
            (F.col("depth") >= F.col("top")) & (F.col("depth") < F.col("cut_depth"))).select(F.col("nid").alias("a_nid")).distinct()
        seen = state.join(cuts.drop("cut_rep", "top"), "comp", "left")
        seen = seen.join(through, (F.col("comp") == F.col("t_comp")) & (F.col("rep") == F.col("t_conv")), "left")
        seen = seen.join(above, F.col("nid") == F.col("a_nid"), "left")
        seen = scratch(seen.select(
            *state.columns, "cut", "lost", (F.col("child").isNotNull() & (F.col("depth") >= F.col("cut_depth"))).alias("below"),
            F.col("a_nid").isNotNull().alias("above"), "child"), "seen")
        totals = seen.where("below").groupBy("comp").agg(*[F.sum(v).alias(f"t_{v}") for v in VALUES])
        is_cut = F.coalesce(F.col("nid") == F.col("cut"), F.lit(False))
        gains = (F.col("above") | is_cut) & F.col("cut").isNotNull()
        added = scratch(seen.join(totals, "comp", "left").select(
            "nid", "parent", "depth", "rep", F.when(F.col("below") & ~is_cut, F.col("child")).otherwise(F.col("comp")).alias("comp"),
            (F.col("weight") - F.when(F.col("above") & F.col("cut").isNotNull(), F.col("lost")).otherwise(0)).alias("weight"), *VALUES,
            *[(F.col(f"sum_{v}") + F.when(gains, F.col(f"t_{v}")).otherwise(0)).alias(f"sum_{v}") for v in VALUES],
            is_cut.alias("is_cut")), "added")
        ended = scratch(added.where("is_cut").select("nid", *[f"sum_{v}" for v in VALUES]), "ended")
        done = ended if done is None else done.unionByName(ended)
        for used in (state, cuts, seen):
            drop_scratch(used)
        state = added.where("not is_cut").drop("is_cut")
    packed = state.select("nid", "parent", "comp", "depth", "weight", *VALUES).repartition("comp").sortWithinPartitions("comp")
    inside = packed.mapInArrow(_split_batches, "nid bigint, " + ", ".join(f"in_{v} bigint" for v in VALUES))
    rest = state.join(inside, "nid").select("nid", *[(F.col(f"sum_{v}") + F.col(f"in_{v}")).alias(f"sum_{v}") for v in VALUES])
    return rest if done is None else rest.unionByName(done)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(nid, conv_id)`` as texts of at most :data:`PIECE_IDS` ids of one node, with each text's first id."""
    for batch in batches:
        nid, conv = np.asarray(batch.column("nid")), np.asarray(batch.column("conv_id"))
        if not len(nid):
            continue
        edge = np.flatnonzero(np.diff(nid)) + 1
        cuts = np.unique(np.concatenate([[0, len(nid)], edge, *[np.arange(a, b, PIECE_IDS) for a, b in zip([0, *edge], [*edge, len(nid)]) if b - a > PIECE_IDS]]))
        begin = cuts[:-1].astype(np.int64)
        texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(nid[begin]), pa.array(conv[begin]), pa.array(texts, pa.string())], names=["nid", "first", "piece"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in order, one piece in memory at a time."""
    node, state, out = None, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["nid", "ends"])

    for batch in batches:
        for nid, piece in zip(batch.column("nid").to_pylist(), batch.column("piece")):
            if nid != node:
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = nid, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_py().encode())
        if len(out) >= PASS_ROWS:
            yield batch_of(out)
            out = []
    if state is not None:
        out.append((node, state.hexdigest()))
    if out:
        yield batch_of(out)


def end_hashes(ends: DataFrame) -> DataFrame:
    """``(nid, ends)``: SHA-256 of the comma-joined ids, ascending, of all ``(nid, conv_id)`` rows of a node.

    Ids are joined where a sort by (node, id) has put them, so a node of most
    conversations is spread over tasks; only its joined pieces meet, one after
    the other, as the hash is over their whole run.
    """
    order = ["nid", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "nid bigint, first bigint, piece string")
    return pieces.repartition("nid").sortWithinPartitions("nid", "first").mapInArrow(_hashed, "nid bigint, ends string")


def prefix_rollup(turns: DataFrame, local_weight: int = LOCAL_WEIGHT) -> DataFrame:
    """One row per trie node of the rebuilt conversations of ``(conv_id, turn, role, text)``.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``: ``conv_id`` is the smallest member.

    Turns go by number, null first; equal numbers go by role, then text (by its
    first :data:`TIE_CHARS` characters, then by hash). Null roles and texts are
    empty; repeated rows are repeated turns. A null ``conv_id`` names no
    conversation, its rows are left out. The first conversation of a family is
    ``c - c % 20`` with the sign of ``c``. A conversation without rebuilt turns
    is a member of the root only. An empty table gives no rows, not even a
    root. Only the four columns are read. Very long texts go on as hashes; very
    long conversations are cut into blocks, none is gathered in one row.
    """
    marked, lengths = rebuilt(turns.select("conv_id", "turn", "role", "text"))
    path = scratch(paths(marked, lengths), "paths")
    nodes = scratch(trie(path), "trie")
    keys = ["depth", "k1", "k2"]
    named = scratch(path.join(nodes.select(*keys, "nid"), keys).select("conv_id", "depth", "nid", "len"), "named")
    ends = end_hashes(named.where(F.col("len") == F.col("depth")).select("nid", "conv_id"))
    own = named.join(nodes.select(F.col("rep").alias("conv_id")).distinct(), "conv_id", "left_semi")
    following = own.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("nid").alias("child"))
    ways = scratch(own.join(following, ["conv_id", "depth"], "left"), "ways")
    valued = nodes.select("nid", "parent", "depth", "rep", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("tokens"))
    sums = rolled_up(valued, ways, local_weight)
    empty = hashlib.sha256().hexdigest()
    return nodes.join(sums, "nid").join(ends, "nid", "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent_rep").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("sum_leaves").alias("n_leaves"), F.col("sum_tokens").alias("saved_tokens"), F.coalesce("ends", F.lit(empty)).alias("ends_sha256"))


ORACLE = """
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
        {'r': coalesce(role, ''), 't': coalesce(text, '')} as v
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
c as (select conv_id, conv_id - conv_id % 20 as base,
        xor(list_reduce(flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0])),
            lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295::bigint), 4294967295) % 4 as h
    from (select distinct conv_id from t)),
turns as (select c.conv_id, 0 as part, t.i, t.v from c join t on t.conv_id = c.base and t.i <= c.h
    union all select c.conv_id, 1, t.i, t.v from c join t on t.conv_id = c.conv_id and t.i > c.h),
whole as materialized (select c.conv_id, coalesce(w.v, []) as v
    from c left join (select conv_id, list(v order by part, i) as v from turns group by conv_id) w on w.conv_id = c.conv_id),
members as materialized (select conv_id, d, v[1:d] as k, len(v) = d as ends from whole, lateral (select unnest(range(len(v) + 1)) as d)),
nodes as materialized (select k, d, min(conv_id) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where ends), '')) as ends_sha256,
        (count(*) - 1) * case when d = 0 then 0 else len(regexp_extract_all(k[d].t, '[^\x20\x09-\x0D]+')) end as saved
    from members group by k, d),
kids as materialized (select n.k, n.d, count(ch.k) as n_children from nodes n left join nodes ch on ch.d = n.d + 1 and ch.k[1:n.d] = n.k group by n.k, n.d),
under as (select n.k, n.d, sum(case when x.n_children = 0 then 1 else 0 end)::bigint as n_leaves, sum(m.saved)::bigint as saved_tokens
    from nodes n join nodes m on m.d >= n.d and m.k[1:n.d] = n.k join kids x on x.k = m.k and x.d = m.d group by n.k, n.d)
select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, x.n_children, u.n_leaves, u.saved_tokens, n.ends_sha256
from nodes n join kids x on x.k = n.k and x.d = n.d join under u on u.k = n.k and u.d = n.d
left join nodes p on p.d = n.d - 1 and p.k = n.k[1:n.d - 1]
"""
