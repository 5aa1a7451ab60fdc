"""Near-duplicate documents by ProbMinHash.

A document is its five-word shingles with their counts. Each shingle emits a
Poisson process of arrivals, as fast as its weight; every arrival goes to a
random register, and a register keeps the shingle that came first. Two
registers agree with the probability Jaccard similarity of the documents.
Bands of registers propose pairs, registers estimate them, texts decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import components, drop_scratch, grams, mix, scratch, slices, stream, utf8, whole, word_runs
from .sharding import _numbered

WORDS, THRESHOLD = 5, 0.8
#: 24 bands of 6: a pair at 0.8 shares a band with probability 0.9993, a pair at 0.4 with 0.1.
BANDS, ROWS = 24, 6
#: Buckets of up to so many different documents are compared in full, larger ones against their hubs.
FULL_BUCKET = 16
HUBS = 3
#: Members of an open bucket are compared in pairs of blocks of about so many documents and bytes of text.
BLOCK_DOCS, BLOCK_BYTES = 256, 4 << 20
#: Shingles of one matrix product.
PRODUCT = 2048
#: Estimates may be this many standard errors below the threshold and still be verified.
SIGMAS = 4.0


def shingles(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, their counts and the text each is in, ordered by text.

    Words are runs of letters, digits and non-ASCII characters, in lower case.
    """
    raw, starts = utf8(pc.utf8_lower(texts))
    _, _, hashes, first = word_runs(raw, starts)
    gram, owner = grams(hashes, first, n)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return gram[at], np.diff(np.append(at, len(gram))), owner[at]


def prob_minhash(gram: np.ndarray, weight: np.ndarray, owner: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Register tags (docs x registers, 32 bits of the shingle that came first).

    Arrivals are generated in rounds, the i-th of each shingle in round i, and
    only up to a horizon by which all registers of a document are likely full;
    a shingle whose next arrival is later ends there. Documents with an empty
    register go again with twice the horizon, so the result is the exact first
    arrival. A document without shingles gets zeros.
    """
    none = np.uint64(2**64 - 1)
    filled = np.full(docs * registers, none, np.uint64)
    total = np.bincount(owner, weights=weight, minlength=docs)
    horizon = np.divide(registers * (np.log(registers) + 3), total, out=np.zeros(docs), where=total > 0)
    todo = np.arange(len(gram))
    while len(todo):
        live, time = todo, np.zeros(len(todo))
        i = 0
        while len(live):
            draw = stream(gram[live], 2 * i)
            time = time - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight[live]
            soon = time <= horizon[owner[live]]
            live, time = live[soon], time[soon]
            register = (stream(gram[live], 2 * i + 1) % np.uint64(registers)).astype(np.int64)
            first = time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
            np.minimum.at(filled, owner[live] * registers + register, first | (gram[live] >> np.uint64(32)))
            i += 1
        short = (filled.reshape(docs, registers) == none).any(axis=1) & (total > 0)
        todo = todo[short[owner[todo]]]
        horizon[short] *= 2
    tags = (filled & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(docs, registers)
    tags[total == 0] = 0
    return tags


SIGNED = "doc_id {id}, cls binary, bands array<bigint>, sig binary, text_hash bigint"


def _sign(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                size, texts = part.num_rows, part.column(1)
                gram, count, owner = shingles(texts, n)
                # Equal shingles with equal counts make one class; sums do not depend on their order.
                one, two = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
                np.add.at(one, owner, mix(gram + count.astype(np.uint64)))
                np.add.at(two, owner, stream(gram, 7) * (count.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
                empty = np.bincount(owner, minlength=size) == 0
                tags = prob_minhash(gram, count.astype(np.float64), owner, size, bands * rows)
                key = np.zeros((size, bands), np.uint64)
                for r in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + tags[:, r::rows].astype(np.uint64))
                key = mix(key + np.arange(bands, dtype=np.uint64))
                cls = np.stack([one, two], 1)
                classes = [c.tobytes() for c in cls]
                for i in np.flatnonzero(empty):  # without words only equal texts are copies
                    classes[i] = b"t" + hashlib.sha256((texts[i].as_py() or "").encode()).digest()
                offsets = np.arange(size + 1, dtype=np.int32) * bands
                keys = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key.view(np.int64).ravel()))
                keys = pc.if_else(pa.array(empty), pa.array([[]] * size, pa.list_(pa.int64())), keys) if empty.any() else keys
                sig = pa.array([t.astype(np.uint16).tobytes() for t in tags], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(classes, pa.binary()), keys, sig, part.column(2)],
                    names=["doc_id", "cls", "bands", "sig", "text_hash"])
    return run


def _estimate(registers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint16).reshape(-1, registers)
                               for n in ("sig_a", "sig_b"))
                same = (left == right).mean(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same)], names=["a", "b", "estimate"])
    return run


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """J_P of two weight vectors over the same elements, by one sort of the ratios."""
    if not len(x):
        return 1.0
    with np.errstate(divide="ignore"):
        order = np.argsort(-np.where(y > 0, x / np.where(y > 0, y, 1), np.inf), kind="stable")
    x, y = x[order], y[order]
    # Before and at an element: ratios at least its own, where x decides; after it, y does.
    x_sum, y_rest = np.cumsum(x), y.sum() - np.cumsum(y)
    both = (x > 0) & (y > 0)
    return float((1.0 / (x_sum[both] / x[both] + y_rest[both] / y[both])).sum())


def _verify(n: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            step = 256
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                size = part.num_rows
                texts = pa.concat_arrays([part.column("text_a").cast(pa.large_string()), part.column("text_b").cast(pa.large_string())])
                gram, count, owner = shingles(texts, n)
                cut = np.searchsorted(owner, np.arange(2 * size + 1))
                for i in range(size):
                    a, b = slice(cut[i], cut[i + 1]), slice(cut[size + i], cut[size + i + 1])
                    every = np.union1d(gram[a], gram[b])
                    x, y = np.zeros(len(every)), np.zeros(len(every))
                    x[np.searchsorted(every, gram[a])] = count[a]
                    y[np.searchsorted(every, gram[b])] = count[b]
                    similarity = probability_jaccard(x, y)
                    if similarity >= threshold:
                        kept.append(low + i)
                        found.append(similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(kept, pa.int64())) for c in ("a", "b")] + [pa.array(found, pa.float64())],
                names=["a", "b", "similarity"])
    return run


def _product(feature: np.ndarray, value: np.ndarray, owner: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the documents ``left`` with those ``right``; a document has each feature once at most."""
    docs = max(int(left.max()), int(right.max())) + 1
    _, at, times = np.unique(feature, return_inverse=True, return_counts=True)
    shared = times > 1
    keep = shared[at]
    at, value, owner = (np.cumsum(shared) - 1)[at[keep]], value[keep], owner[keep]
    order = np.argsort(at, kind="stable")
    at, value, owner = at[order], value[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for low in range(0, int(shared.sum()), PRODUCT):
        a, b = np.searchsorted(at, [low, low + PRODUCT])
        dense = np.zeros((docs, PRODUCT), np.float32)
        dense[owner[a:b], at[a:b] - low] = value[a:b]
        out += dense[left] @ dense[right].T
    return out


def upper_bounds(gram: np.ndarray, count: np.ndarray, owner: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """At least J_P of each document ``left`` with each ``right``, but for rounding; J_P itself where all counts are one.

    A shingle that both have equally often adds its count over the sum of the
    larger counts; any other adds the smaller of its two shares at most, which
    is no more than their geometric mean.
    """
    total = np.bincount(owner, weights=count, minlength=max(int(left.max()), int(right.max())) + 1)
    close = _product(gram, np.sqrt(count / total[owner]), owner, left, right)
    equal = _product(mix(gram + count.astype(np.uint64)), np.sqrt(count), owner, left, right)
    x, y = total[left][:, None], total[right][None, :]
    mean = np.sqrt(x * y)
    return equal / (x + y - mean * close) + close - equal / mean


def _between(n: int, threshold: float):
    """Links that join components, of the members of two blocks of a bucket."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        node, comp, block, i, j = (group[c].to_numpy() for c in ("node", "comp", "block", "i", "j"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found: list[tuple] = []
        if len(left) and len(right) and (comp != comp[0]).any():
            gram, count, owner = shingles(pa.concat_arrays(group["text"].cast(pa.large_string()).chunks), n)
            wanted = (upper_bounds(gram, count, owner, left, right) >= threshold - 1e-3) & (comp[left][:, None] != comp[right][None, :])
            if i[0] == j[0]:
                wanted &= left[:, None] < right[None, :]
            cut = np.searchsorted(owner, np.arange(len(node) + 1))
            root: dict = {}

            def top(c):
                while root.get(c, c) != c:
                    root[c] = c = root.get(root[c], root[c])
                return c

            for k, m in zip(*np.nonzero(wanted)):
                a, b = int(left[k]), int(right[m])
                if top(comp[a]) == top(comp[b]):
                    continue
                one, two = slice(cut[a], cut[a + 1]), slice(cut[b], cut[b + 1])
                every = np.union1d(gram[one], gram[two])
                x, y = np.zeros(len(every)), np.zeros(len(every))
                x[np.searchsorted(every, gram[one])] = count[one]
                y[np.searchsorted(every, gram[two])] = count[two]
                similarity = probability_jaccard(x, y)
                if similarity >= threshold:
                    root[top(comp[a])] = top(comp[b])
                    found.append((comp[a], comp[b], similarity))
        columns = list(zip(*found)) if found else [[]] * 3
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"])
    return run


def between_components(large: DataFrame, joined: DataFrame, source: DataFrame, classes: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between the components of ``joined``, as members ``(key, node)`` of large buckets give them.

    A bucket in one component is done. In the others, the open ones, every
    pair from two components is bounded, a block of members against another
    by matrix products, and what may reach the threshold is compared exactly
    until its components are one. Nothing is sampled; tasks return no more
    links than there are components to join.
    """
    placed = scratch(large.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")), "placed")
    open_ = scratch(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
                    .where("low < high").select("key", "n"), "open")
    if not open_.limit(1).count():
        return open_.select(F.col("key").alias("a"), F.col("key").alias("b"))
    inside = scratch(placed.join(open_, "key"), "inside")
    drop_scratch(placed)
    texts = scratch(_texts_of(source, inside.select("node").distinct().join(classes, "node").select("node", "rep", "text_hash")), "open-texts")
    sizes = inside.join(texts.select("node", F.octet_length("text").cast("long").alias("size")), "node")
    blocks = sizes.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("size") / BLOCK_BYTES)).alias("blocks"))
    dealt = inside.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("key", "node", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    pairs = dealt.join(texts, "node").groupBy("key", "i", "j")
    return scratch(pairs.applyInArrow(_between(words, threshold), "a bigint, b bigint, similarity double"), "joins").select("a", "b")


def candidate_pairs(nodes: DataFrame, full: int = FULL_BUCKET, hubs: int = HUBS) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` of nodes that share a band's bucket, each once, for nodes ``(node, copies, bands)``.

    A bucket of two is its pair, small ones give all their pairs. A large one
    is compared with its hubs: the node most documents copy, which is most
    often the original, and some that differ from band to band; its members
    ``(key, node)`` are the second table, for :func:`between_components`.
    """
    held = scratch(nodes.select("node", "copies", F.explode("bands").alias("key")), "buckets")
    sizes = scratch(held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
                    .where("n > 1"), "sizes")
    members = scratch(held.join(sizes.where("n > 2").select("key", "n"), "key"), "members")
    drop_scratch(held)
    small = members.where(F.col("n") <= full).select("key", F.col("node").alias("a"))
    others = small.withColumnRenamed("a", "b")
    pairs = small.join(others, "key").where(F.col("a") < F.col("b")).select("a", "b")
    large = members.where(F.col("n") > full)
    chosen = large.groupBy("key").agg(
        F.max(F.struct("copies", F.xxhash64("node").alias("h"), "node"))["node"].alias("h0"),
        *[F.min(F.struct(F.xxhash64("node", "key", F.lit(i)).alias("h"), "node"))["node"].alias(f"h{i}") for i in range(1, hubs)])
    chosen = scratch(chosen.select("key", F.explode(F.array_distinct(F.array(*[f"h{i}" for i in range(hubs)]))).alias("hub")), "hubs")
    star = large.join(chosen, "key").where(F.col("node") != F.col("hub")).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    return sizes.where("n = 2").select("a", "b").unionByName(pairs).unionByName(star).distinct(), large.select("key", "node")


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose texts ``(node, text)`` are similar enough."""
    both = (pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return scratch(both.mapInArrow(_verify(words, threshold), "a bigint, b bigint, similarity double"), "links")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD,
                    words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document row: ``(doc_id, class_id, kept)``.

    ``class_id`` is the smallest doc_id reachable over links, a link being a
    verified similarity of at least ``threshold``; ``kept`` is doc_id = class_id.
    Documents with equal shingles are one class from the start; texts without
    words (null, empty, signs only) are copies only of equal texts. A null
    doc_id is a class's id only if all its rows are null. Repeated rows
    keep a row each. Other columns are not carried; an empty table gives no rows.

    A pair inside a component found so far is no longer needed, so texts of
    large groups move a few times, not once per pair. Buckets too large to be
    compared in full are, in the end, compared between their components.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"), F.xxhash64(whole(text)).alias("text_hash"))
    signed = _numbered(scratch(source.mapInArrow(_sign(words, bands, rows), SIGNED.format(id=id_type)), "signed"))
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "nid", "text_hash"))
    classes = scratch(signed.groupBy("cls").agg(lowest.alias("m"), F.count(F.lit(1)).alias("copies")).select(
        "cls", "copies", F.col("m.doc_id").alias("rep"), F.col("m.nid").alias("node"), "m.text_hash"), "classes")
    members = scratch(signed.select("doc_id", "cls"), "doc-classes")
    nodes = scratch(signed.select(F.col("nid").alias("node"), "bands", "sig").join(classes.select("node", "copies"), "node"), "nodes")
    drop_scratch(signed)
    pairs, large = candidate_pairs(nodes)
    pairs = scratch(pairs, "pairs")
    sig = nodes.select("node", "sig")
    signed_pairs = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
                    .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))
    registers = bands * rows
    least = threshold - SIGMAS * (threshold * (1 - threshold) / registers) ** 0.5
    likely = scratch(signed_pairs.mapInArrow(_estimate(registers), "a bigint, b bigint, estimate double")
                     .where(F.col("estimate") >= least), "likely")
    drop_scratch(nodes)
    ends = likely.select("a", "b", "estimate", F.explode(F.array("a", "b")).alias("node"))
    best = scratch(ends.groupBy("node").agg(F.max(F.struct("estimate", "a", "b")).alias("p")).select("node", "p.a", "p.b"), "best")
    wanted = scratch(best.select("node").join(classes, "node").select("node", "rep", "text_hash"), "wanted")
    texts = scratch(_texts_of(source, wanted), "texts")
    # Three waves: each node's likeliest pair, the likeliest pair between components, then whatever is still between components.
    links = verified(best.select("a", "b").distinct(), texts, words, threshold)
    tried = best.select("a", "b")
    between = _apart(likely, components(links)).groupBy("ca", "cb").agg(F.max(F.struct("estimate", "a", "b")).alias("p"))
    between = scratch(between.select("p.a", "p.b").join(tried, ["a", "b"], "left_anti"), "between")
    links = links.unionByName(verified(between, texts, words, threshold))
    rest = _apart(likely, components(links)).select("a", "b").join(tried.unionByName(between), ["a", "b"], "left_anti")
    links = links.unionByName(verified(rest, texts, words, threshold))
    joined = components(links)
    more = between_components(large, joined, source, classes, words, threshold)
    by_class = classes.join(joined, "node", "left").select("cls", "rep", F.coalesce("component", "node").alias("component"))
    wider = components(more).select(F.col("node").alias("component"), F.col("component").alias("wider"))
    by_class = by_class.join(wider, "component", "left").select("cls", "rep", F.coalesce("wider", "component").alias("component"))
    smallest = by_class.groupBy("component").agg(F.min("rep").alias("class_id"))
    final = scratch(by_class.join(smallest, "component").select("cls", "class_id"), "final")
    return members.join(final, "cls").select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with those as ``ca`` < ``cb``."""
    side = [joined.select(F.col("node").alias(x), F.col("component").alias(f"_{x}")) for x in ("a", "b")]
    found = pairs.join(side[0], "a", "left").join(side[1], "b", "left")
    one, two = F.coalesce("_a", "a"), F.coalesce("_b", "b")
    return found.where(one != two).select("a", "b", "estimate", F.least(one, two).alias("ca"), F.greatest(one, two).alias("cb"))


def _texts_of(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """Text of each wanted node; an id that repeats with another text is told apart by its hash.

    Always a shuffled join: what is wanted grows with the corpus.
    """
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("s.text_hash") == F.col("w.text_hash"))
    return source.alias("s").hint("merge").join(wanted.alias("w"), same).select("node", "text").dropDuplicates(["node"])
