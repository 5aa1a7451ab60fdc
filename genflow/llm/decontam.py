"""Benchmark decontamination: rare gapped pairs of words as seeds, then Smith-Waterman alignment.

With two points for a match and one off for each replaced, added or missing
word, an alignment of score S has at least S/2 - 1 neighbouring matches with
one such edit between them at most (those with two or more edits in between
cost two each, and there are no more than 2m - S edits for m matches). So the
pairs of words (i, i+1) and (i, i+2) of an item, looked up among the same
pairs of a document, find every passage that reaches the threshold: of an
item's starts i so many are hit that its rarest ones alone, all but a known
number, must have some hits within the passage's greatest length. Only these
rare seeds join documents and items; what they find is aligned word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import drop_scratch, free_name, mix, scratch, slices, utf8, whole, word_runs
from .sharding import _numbered

#: Share of an item's best possible score that a passage must reach.
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: A passage must score as much as so many words in a row, or as the whole item if that is shorter.
LEAST_WORDS = 6
#: How many of an item's rare starts a passage must hit; more are joined the more it must hit.
RARE_HITS = 4
#: Bits a seed of the filter that documents go through, and its size in bits at most.
FILTER_BITS, MOST_FILTER_BITS = 32, 1 << 27
#: Tables of at most so many bytes are sent to every executor; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Bytes of text that one numpy pass works on.
SLICE_BYTES = 1 << 19
_ODD = np.uint64(0xD6E8FEB86659FD93)


def least_score(words: int, threshold: float) -> int:
    """The score a passage must reach for an item of so many words."""
    return max(int(np.ceil(MATCH * words * threshold - 1e-9)), MATCH * min(words, LEAST_WORDS))


def least_starts(score: int) -> int:
    """How many of an item's starts an alignment of this score hits at least."""
    return -(-score // 2) - 1


def pairs(words: np.ndarray, first: np.ndarray, singles: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each pair of words one or two apart inside one text; with ``singles`` of each word too."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams, places = [], []
    for gap in (1, 2):
        inside = np.flatnonzero(owner[:-gap] == owner[gap:]) if len(owner) > gap else np.zeros(0, np.int64)
        grams.append(mix(words[inside] * _ODD + words[inside + gap]))
        places.append(inside)
    if singles:
        grams.append(mix(words + _ODD))
        places.append(np.arange(len(words)))
    return np.concatenate(grams), np.concatenate(places)


def _hits(grams_: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Which hashes are among sorted distinct ones."""
    if not len(distinct) or not len(grams_):
        return np.zeros(len(grams_), bool)
    at = np.searchsorted(distinct, grams_)
    at[at == len(distinct)] = 0
    return distinct[at] == grams_


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score, and where its alignment ends in the item and in the passage (exclusive).

    Row by row; a gap inside the row is a running maximum, as its cost is linear.
    """
    row = np.zeros(len(passage) + 1, np.int64)
    slope = -GAP * np.arange(len(passage) + 1)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        score = np.where(passage == word, MATCH, MISMATCH)
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + score, row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + slope) - slope
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), i + 1, at)
    return best


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Score as a share of the item's best, and the aligned words' start and end in the passage."""
    score, i, end = smith_waterman(item, passage)
    if not score:
        return 0.0, 0, 0
    _, _, back = smith_waterman(item[:i][::-1], passage[:end][::-1])
    return score / (MATCH * len(item)), end - back, end


def _common(item: np.ndarray, passage: np.ndarray) -> int:
    """Words that both have, each as often as in the one that has it less: no alignment matches more."""
    kinds, times = np.unique(item, return_counts=True)
    there = passage[_hits(passage, kinds)]
    return int(np.minimum(times, np.bincount(np.searchsorted(kinds, there), minlength=len(kinds))).sum())


def _words_of(texts: pa.Array):
    _, _, hashes, first = word_runs(*utf8(pc.utf8_lower(texts)))
    return hashes, first


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, first = _words_of(batch.column("text"))
        listed = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("item"), listed], names=["item", "words"])


def _seeds(threshold: float):
    """Seeds of items: each start's pairs, how many starts are to be joined, and how many of them a passage must hit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, listed in zip(batch.column("item").to_pylist(), batch.column("words")):
                words = np.asarray(listed.values).astype(np.int64).view(np.uint64)
                size = len(words)
                gram, at = pairs(words, np.array([0, size]), size == 1)
                score = least_score(size, threshold)
                starts, sure = max(1, size - 1), max(1, least_starts(score))
                hits = min(RARE_HITS, sure)
                joined = starts - sure + hits
                n = len(gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * n, pa.int64()), pa.array(at, pa.int64()), pa.array(gram.view(np.int64)), pa.array([joined] * n, pa.int64()),
                     pa.array([hits] * n, pa.int64()), pa.array([3 * size - score] * n, pa.int64())],
                    names=["item", "start", "gram", "joined", "hits", "span"])
    return run


def _probes(gram: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(gram + np.uint64(i)) & np.uint64(bits - 1) for i in range(3)]


def _filter(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of all seeds' hashes, of bounded size: what passes it may be a seed, what does not is none."""
    n = seeds.select("gram").distinct().count()
    bits = 1 << max(10, min(MOST_FILTER_BITS, FILTER_BITS * n).bit_length())
    bits = min(bits, MOST_FILTER_BITS)

    def set_bits(batches):
        for batch in batches:
            at = np.unique(np.concatenate(_probes(np.asarray(batch.column("gram")).view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))],
                                             names=["word", "bit"])

    rows = seeds.select("gram").mapInArrow(set_bits, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(bits >> 6, np.uint64)
    found = rows.toArrow()  # at most bits / 64 rows
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table, bits


def _passing(gram: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Places of the hashes that may be seeds."""
    left = np.arange(len(gram))
    for i in range(3):
        at = mix(gram[left] + np.uint64(i)) & np.uint64(bits - 1)
        left = left[(table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
    return left


def _found(shared, singles: bool):
    """Document pairs that may be seeds: (text, place of the first word, hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, first = _words_of(part.column("text"))
                gram, at = pairs(hashes, first, singles)
                kept = _passing(gram, table, bits)
                gram, at = gram[kept], at[kept]
                text = np.searchsorted(first, at, "right") - 1
                t1, t2 = (np.asarray(part.column(c))[text] for c in ("t1", "t2"))
                yield pa.RecordBatch.from_arrays([pa.array(t1), pa.array(t2), pa.array(at - first[text], pa.int64()), pa.array(gram.view(np.int64))],
                                                 names=["t1", "t2", "pos", "gram"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each window of each text."""
    for batch in batches:
        for row in range(batch.num_rows):
            hashes, _ = _words_of(batch.column("text").slice(row, 1))
            hashes = hashes.view(np.int64)
            windows = batch.column("windows")[row].as_py()
            low = [w["cell"] * w["span"] for w in windows]
            parts = [hashes[a:a + 2 * w["span"]] for a, w in zip(low, windows)]
            n = len(windows)
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("t1")[row].as_py()] * n, pa.int64()), pa.array([batch.column("t2")[row].as_py()] * n, pa.int64()),
                 pa.array([w["item"] for w in windows], pa.int64()), pa.array(low, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["t1", "t2", "item", "low", "passage"])


def place(item: np.ndarray, passage: np.ndarray, threshold: float) -> tuple[float, int, int] | None:
    """Share, start and end of the best place of an item in a passage, if it reaches the threshold.

    Passages that share too few starts or words with the item to do so are not aligned.
    """
    score = least_score(len(item), threshold)
    if len(item) > 1:
        gram, at = pairs(item, np.array([0, len(item)]))
        there, _ = pairs(passage, np.array([0, len(passage)]))
        if len(np.unique(at[_hits(gram, np.unique(there))])) < least_starts(score):
            return None
    if MATCH * _common(item, passage) < score:
        return None
    share, start, end = align(item, passage)
    return (share, start, end) if share * MATCH * len(item) > score - 0.5 else None


def _aligned(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (words, passage) in enumerate(zip(batch.column("words"), batch.column("passage"))):
                best = place(np.asarray(words.values).view(np.uint64), np.asarray(passage.values).view(np.uint64), threshold)
                if best:
                    rows.append((i, *best))
            at = pa.array([r[0] for r in rows], pa.int64())
            low = np.asarray(batch.column("low"))[np.array([r[0] for r in rows], np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in ("t1", "t2", "item")), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array(low + np.array([r[2] for r in rows], np.int64)), pa.array(low + np.array([r[3] for r in rows], np.int64))],
                names=["t1", "t2", "item", "score", "start_word", "end_word"])
    return run


def _named(docs: DataFrame, text: str) -> list:
    """Two hashes that name a text."""
    body = whole(text)
    return [F.xxhash64(body), F.xxhash64(F.lit("text"), body)]


def _small(table: DataFrame, row_bytes: int) -> DataFrame:
    """``table``, marked to be sent to every executor if its counted rows fit the bound."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def leaked_texts(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Places ``(t1, t2, item, score, start_word, end_word)`` of items in texts, and the numbered benchmark; texts by their two hashes.

    Each different text is cut and aligned once, however often it occurs.
    """
    items = _numbered(scratch(benchmark, "benchmark"))
    words = scratch(items.select(F.col("nid").alias("item"), whole(item_text).alias("text")).mapInArrow(
        _item_words, "item bigint, words array<bigint>").where(F.size("words") > 0), "items")
    seeds = scratch(words.mapInArrow(_seeds(threshold), "item bigint, start bigint, gram bigint, joined bigint, hits bigint, span bigint"), "seeds")
    empty = docs.sparkSession.createDataFrame([], "t1 bigint, t2 bigint, item bigint, score double, start_word bigint, end_word bigint")
    if seeds.isEmpty():
        return empty, items
    singles = not words.where(F.size("words") == 1).isEmpty()
    shared = docs.sparkSession.sparkContext.broadcast(_filter(seeds))
    t1, t2 = _named(docs, text)
    texts = docs.select(t1.alias("t1"), t2.alias("t2"), whole(text).alias("text"))
    found = scratch(texts.mapInArrow(_found(shared, singles), "t1 bigint, t2 bigint, pos bigint, gram bigint"), "found")
    # How often each seed occurs in all documents; a start is as rare as its pairs together.
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    known = seeds.join(often, "gram", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    starts = known.groupBy("item", "start", "joined").agg(F.sum("often").alias("often"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("often", "start"))
    rare = starts.withColumn("rank", rank).where("rank <= joined").select("item", "start")
    joined = scratch(seeds.join(rare, ["item", "start"]).select("item", "start", "gram", "hits", "span").distinct(), "rare")
    hits = found.join(_small(joined, 64), "gram")
    cell = F.floor(F.col("pos") / F.col("span")).cast("bigint")
    # A passage of at most `span` words lies in the two cells from its first word's on.
    celled = hits.select("t1", "t2", "item", "start", "hits", "span", F.explode(F.array(cell, cell - 1)).alias("cell")).where("cell >= 0")
    windows = celled.distinct().groupBy("t1", "t2", "item", "cell", "hits", "span").agg(F.count(F.lit(1)).alias("n")).where("n >= hits")
    windows = scratch(windows.select("t1", "t2", "item", "cell", "span"), "windows")
    drop_scratch(found)
    wanted = scratch(windows.groupBy("t1", "t2").agg(F.collect_list(F.struct("item", "cell", "span")).alias("windows")), "wanted")
    one = texts.join(_small(wanted.select("t1", "t2"), 48), ["t1", "t2"]).groupBy("t1", "t2").agg(F.min("text").alias("text"))
    # Stored, so that a task never holds two Python workers, one for each step.
    passages = scratch(one.join(wanted, ["t1", "t2"]).mapInArrow(_cut, "t1 bigint, t2 bigint, item bigint, low bigint, passage array<bigint>"), "passages")
    placed = passages.join(words, "item").mapInArrow(_aligned(threshold), empty.schema)
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct(F.col("score"), -F.col("start_word")))
    return scratch(placed.groupBy("t1", "t2", "item").agg(best.alias("best")).select("t1", "t2", "item", "best.*"), "leaks"), items


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
                 item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs ``(doc_id, item_id, score, start_word, end_word)`` of documents that hold a test item: all there are.

    ``score`` is the best local alignment's share of the item's full score, at
    least ``threshold`` and at least that of :data:`LEAST_WORDS` words in a row
    (of the whole item, if shorter); the words are those of the document in
    which it lies. Only the best place per item and document is given, of equal
    ones the first. Null and empty texts hold nothing, and an item without
    words is found nowhere. Repeated rows give repeated pairs; ids may be of
    any type and null. Without documents or items there are no rows; other
    columns are not carried, whatever their names.

    Document pairs that may be seeds pass a filter of bounded size and are
    joined with the items' rarest seeds; copies of a text are aligned once, and
    no table is sent to all executors but below :data:`BROADCAST_BYTES`.
    """
    leaks, items = leaked_texts(docs, benchmark, text, item_text, threshold)
    t1, t2 = _named(docs, text)
    named = docs.select(F.col(doc_id).alias("doc_id"), t1.alias("t1"), t2.alias("t2"))
    held = named.join(_small(leaks, 64), ["t1", "t2"])
    return held.join(items.select(F.col("nid").alias("item"), F.col(item_id).alias("item_id")), "item").select(
        "doc_id", "item_id", "score", "start_word", "end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text",
                      threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a test item, all columns as they are; cases as in :func:`contaminated`."""
    leaks, _ = leaked_texts(docs, benchmark, text, item_text, threshold)
    names = [free_name(docs, "leak_1"), free_name(docs, "leak_2")]
    gone = leaks.select("t1", "t2").distinct().toDF(*names)
    t1, t2 = _named(docs, text)
    return docs.join(_small(gone, 48), (t1 == F.col(names[0])) & (t2 == F.col(names[1])), "left_anti")
