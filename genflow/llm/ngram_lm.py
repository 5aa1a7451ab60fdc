"""Interpolated modified Kneser-Ney n-gram model over a corpus, of any order from two.

Spark counts: each task sends its distinct n-grams, packed and dealt by hash,
to shards of bounded size. A shard is stored in the shared folder as sorted
hash arrays with counts, and sends on the n-grams' ends, one word shorter, with
the number of words seen before them: the counts of the next lower order. Other
shards hold what follows each context, and each word's counts.
Scoring tasks map these files into memory and look up sorted, distinct n-grams.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, functions as F

from .common import NOT_SPACE, PIECE_BYTES, drop_scratch, mix, scratch, scratch_folder, slices, utf8, whole, word_runs

#: Words of an n-gram unless the caller says otherwise.
ORDER = 2
#: Training tokens whose bigrams make one shard, and how many fill a task's buffer; longer n-grams take fewer.
SHARD_TOKENS, FLUSH_TOKENS = 4_000_000, 2_000_000
#: Bytes of text that stand for a token when shards are planned.
BYTES_A_TOKEN = 6
# A word is a 64-bit hash, and its first 48 bits inside n-grams; two values stand for the end and the start of a text.
_CUT = np.uint64(16)
END, START = np.uint64(1) << _CUT, np.uint64(2)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each token, ends included, and how many tokens each text has."""
    raw, starts = utf8(texts)
    raw = _LOWER[raw]
    _, _, hashes, first = word_runs(raw, starts, NOT_SPACE[raw])
    return np.insert(hashes, first[1:], END), np.diff(first) + 1


def windows(token: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """The n-gram that ends at each token, a column per word; start marks stand before a text's first."""
    short = token >> _CUT
    place = np.arange(len(token)) - np.repeat(np.cumsum(counts) - counts, counts)
    columns = [short]
    for back in range(1, order):
        column = np.full_like(short, START)
        column[back:] = np.where(place[back:] >= back, short[:max(0, len(short) - back)], START)
        columns.insert(0, column)
    return columns


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of each n-gram, in pieces that bound the temporary arrays; a single word is its own."""
    if len(columns) == 1:
        return columns[0]
    out = np.empty(len(columns[0]), np.uint64)
    for at in range(0, len(out), 1 << 18):
        part = slice(at, at + (1 << 18))
        h = columns[0][part]
        for column in columns[1:]:
            h = mix(mix(h * _PAIR) + column[part])
        out[part] = h
    return out


def _shard_of(hashes: np.ndarray, shards: int, bits: int) -> np.ndarray:
    """Shards are ranges of the hash, so sorted hashes are dealt as they stand."""
    return ((hashes >> np.uint64(bits - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _pack48(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]


def _unpack48(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :6] = data
    return wide.view("<u8").ravel().astype(np.uint64)


def _starts(values: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array starts."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _cuts(hashes: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    return np.searchsorted(_shard_of(hashes, shards, bits), np.arange(shards + 1))


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands, and whether it is there."""
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return at, sorted_[at] == wanted


BLOCKS = "kind string, shard int, words binary, numbers binary"


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "shard", "words", "numbers"])


#: Bytes of the key in a kind of row, and how many numbers it has.
#: "word": tokens. "total": their sums. "context": tokens after a word, and types after it seen once, twice, more.
#: "long": the same of a context of several words. "follows": types before a word.
_CARRIES = {"word": (8, 1), "total": (8, 1), "context": (6, 4), "long": (8, 4), "follows": (6, 1)}


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The numbers in four bytes each where all fit."""
    return numbers.astype("<u8" if numbers.size and numbers.max() >= 2**32 else "<u4")


def _key_rows(key: np.ndarray, numbers: np.ndarray, shards: int, kind: str) -> list[tuple]:
    """Packed rows of sorted keys with their numbers (one row of the array per key), by shard."""
    size, cut = _CARRIES[kind][0], _cuts(key, shards, 8 * _CARRIES[kind][0])
    return [(kind, s, (_pack48(key[a:b]) if size == 6 else key[a:b].astype("<u8")).tobytes(), _narrow(numbers[a:b]).tobytes())
            for s, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]


def _counted(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each comes."""
    word = np.sort(word)
    at = _starts(word)
    return word[at], np.diff(np.append(at, len(word)))[:, None]


def _gram_rows(columns: list[np.ndarray], shards: int) -> list[tuple]:
    """Packed rows of the distinct n-grams with how often each comes, by shard."""
    key = gram_hash(columns)
    order = np.argsort(key)
    key = key[order]
    at = _starts(key)
    n = np.diff(np.append(at, len(key)))
    one = order[at]
    packed = np.concatenate([_pack48(c[one]) for c in columns], axis=1)
    cut = _cuts(key[at], shards)
    rows = []
    for s, (a, b) in enumerate(zip(cut, cut[1:])):
        if b > a:
            more = np.flatnonzero(n[a:b] > 1)  # most counts are one
            rows.append(("gram", s, packed[a:b].tobytes(), np.stack([more, n[a:b][more]], 1).astype("<u4").tobytes()))
    return rows


def _count(shards: int, order: int):
    def flush(token: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        token, counts = np.concatenate(token), np.concatenate(counts)
        return _blocks(_gram_rows(windows(token, counts, order), shards) + _key_rows(*_counted(token), shards, "word"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, counts, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                t, n = tokens(part.column(0))
                token.append(t)
                counts.append(n)
                held += len(t)
                if held >= 2 * FLUSH_TOKENS // order:
                    yield flush(token, counts)
                    token, counts, held = [], [], 0
        if held:
            yield flush(token, counts)
    return run


def _file(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _store(uri: str, arrays: list[np.ndarray]) -> None:
    """Write arrays end to end; a retried task replaces the file with the same bytes."""
    system, path = _file(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    system.move(part, path)


def _mapped(uri: str) -> np.ndarray:
    """The file's bytes, mapped into memory; from a store without local paths by way of an unnamed copy."""
    system, path = _file(uri)
    if isinstance(system, arrow_fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as source:
        while data := source.read(1 << 24):
            copy.write(data)
        copy.flush()
        return np.memmap(copy, np.uint8, "r")


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _merge_shard(table: pa.Table, folder: str, shards: int, order: int) -> Iterator[tuple]:
    """Store a shard of n-grams; counts of counts, their contexts and their ends go on. A shard of words is added up."""
    shard = table.column("shard")[0].as_py()
    if table.column("kind")[0].as_py() == "word":
        word, number = _added(table, "word")
        yield "total", shard, word.astype("<u8").tobytes(), _narrow(number).tobytes()
        return
    sizes = [len(data.as_buffer()) // (6 * order) for data in table.column("words")]
    columns = [np.empty(sum(sizes), np.uint64) for _ in range(order)]
    c = np.ones(sum(sizes), np.uint32)
    at = 0
    for size, data, numbers in zip(sizes, table.column("words"), table.column("numbers")):
        packed = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, 6 * order)
        for i, column in enumerate(columns):
            column[at:at + size] = _unpack48(packed[:, 6 * i:6 * i + 6])
        more = np.frombuffer(numbers.as_buffer(), "<u4").reshape(-1, 2)
        c[at + more[:, 0].astype(np.int64)] = more[:, 1]
        at += size
    key = gram_hash(columns)
    order_of = np.argsort(key, kind="stable")  # the blocks are sorted runs
    key = key[order_of]
    begin = _starts(key)
    c = np.add.reduceat(c[order_of], begin, dtype=np.int64)
    one, key = order_of[begin], key[begin]
    for i in range(order):
        columns[i] = columns[i][one]
    del order_of, begin, one
    large = np.flatnonzero(c >= 255)
    _store(f"{folder}/gram{order}-{shard}", [key, large.astype("<u8"), c[large].astype("<u8"), np.minimum(c, 255).astype(np.uint8)])
    yield "grams", shard, b"", np.array([len(key), len(large), *_counts_of_counts(c)], "<u8").tobytes()
    del key
    if order == 2:
        yield from _key_rows(*_counted(columns[1]), shards, "follows")
    else:
        yield from _gram_rows(columns[1:], shards)
    context = gram_hash(columns[:-1])
    del columns
    order_of = np.argsort(context)
    context, c = context[order_of], c[order_of]
    at = _starts(context)
    sums = [np.add.reduceat(x, at) for x in (c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), (c >= 3).astype(np.int64))]
    yield from _key_rows(context[at], np.stack(sums, 1), shards, "context" if order == 2 else "long")


def _added(table: pa.Table, *kinds: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the packed rows of these kinds, in order, with the sums of their numbers side by side."""
    wide = sum(_CARRIES[k][1] for k in kinds)
    parts, numbers = [np.zeros(0, np.uint64)], [np.zeros((0, wide), np.int64)]
    for kind, data, values in zip(table.column("kind"), table.column("words"), table.column("numbers")):
        if (name := kind.as_py()) in kinds:
            size, columns = _CARRIES[name]
            packed, values = np.frombuffer(data.as_buffer(), np.uint8), values.as_buffer()
            parts.append(_unpack48(packed.reshape(-1, 6)) if size == 6 else packed.view("<u8").astype(np.uint64))
            before = sum(_CARRIES[k][1] for k in kinds[:kinds.index(name)])
            number = np.zeros((len(parts[-1]), wide), np.int64)
            kind_of = f"<u{values.size // (columns * len(parts[-1]))}"
            number[:, before:before + columns] = np.frombuffer(values, kind_of).reshape(-1, columns)
            numbers.append(number)
    key, number = np.concatenate(parts), np.concatenate(numbers)
    if not len(key):
        return key, number
    order = np.argsort(key, kind="stable")
    at = _starts(key[order])
    return key[order[at]], np.add.reduceat(number[order], at, axis=0)


def _shard_words(table: pa.Table, folder: str) -> Iterator[tuple]:
    """Store a shard of words: their tokens by the whole hash, what follows and precedes them by its first 48 bits."""
    shard = table.column("shard")[0].as_py()
    word, tokens_ = _added(table, "total")
    short, number = _added(table, "context", "follows")
    _store(f"{folder}/word-{shard}", [word, tokens_[:, 0].astype("<u8"), short, wide := _narrow(number.T)])
    follows = number[:, 4]
    yield "words", shard, b"", np.array([len(word), len(short), wide.itemsize, int(tokens_.sum()), int(follows.sum()),
                                         *_counts_of_counts(follows), int((follows > 0).sum())], "<u8").tobytes()


def _shard_contexts(table: pa.Table, folder: str, order: int) -> Iterator[tuple]:
    """Store a shard of contexts of several words."""
    shard = table.column("shard")[0].as_py()
    key, number = _added(table, "long")
    _store(f"{folder}/context{order}-{shard}", [key, wide := _narrow(number.T)])
    yield "contexts", shard, b"", np.array([len(key), wide.itemsize], "<u8").tobytes()


def discounts(held: np.ndarray) -> np.ndarray:
    """Modified discounts for counts 0, 1, 2 and 3 or more from the counts of counts 1 to 4.

    A count of counts of zero leaves its discount at the plain one; all stay within their counts.
    """
    n1, n2, n3, n4 = (float(x) for x in held)
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 > 0 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3)))])


@dataclass
class Model:
    """Where the shards are, how long their arrays, and the corpus totals."""

    folder: str
    shards: int
    order: int
    sizes: dict[str, dict[int, np.ndarray]]
    discounts: dict[int, np.ndarray] = field(default_factory=dict)
    tokens: int = 0
    types: int = 0
    follows: int = 0
    fresh: float = 1.0
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def _part(self, kind: str, shard: int) -> list[np.ndarray]:
        """The arrays of one file."""
        if (kind, shard) not in self._open:
            raw, size = _mapped(f"{self.folder}/{kind}-{shard}"), [int(x) for x in self.sizes[kind][shard]]
            if kind.startswith("gram"):
                lengths = [(size[0], "<u8"), (size[1], "<u8"), (size[1], "<u8"), (size[0], "u1")]
            elif kind == "word":
                lengths = [(size[0], "<u8"), (size[0], "<u8"), (size[1], "<u8"), *[(size[1], f"<u{size[2]}")] * 5]
            else:
                lengths = [(size[0], "<u8"), *[(size[0], f"<u{size[1]}")] * 4]
            found, at = [], 0
            for n, kind_of in lengths:
                end = at + n * np.dtype(kind_of).itemsize
                found.append(raw[at:end].view(kind_of))
                at = end
            self._open[kind, shard] = found
        return self._open[kind, shard]

    def _visit(self, kind: str, key: np.ndarray, bits: int = 64) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """Each shard that sorted keys fall in, once and in order, with the keys' place."""
        cut = _cuts(key, self.shards, bits)
        for s in sorted(self.sizes[kind]):
            if cut[s] < cut[s + 1]:
                yield slice(cut[s], cut[s + 1]), self._part(kind, s)

    def gram_counts(self, key: np.ndarray, order: int) -> np.ndarray:
        """Count of each n-gram hash, for sorted hashes."""
        out = np.zeros(len(key), np.int64)
        for mine, (keys, large, many, small) in self._visit(f"gram{order}", key):
            at, hit = _find(keys, key[mine])
            count = small[at].astype(np.int64)
            big = np.flatnonzero(hit & (count == 255))
            if len(big):
                count[big] = many[np.searchsorted(large, at[big].astype(np.uint64))].astype(np.int64)
            out[mine] = np.where(hit, count, 0)
        return out

    def word_tokens(self, word: np.ndarray) -> np.ndarray:
        """Training tokens of each of sorted 64-bit words."""
        out = np.zeros(len(word), np.int64)
        for mine, (names, count, *_) in self._visit("word", word):
            if len(names):
                at, hit = _find(names, word[mine])
                out[mine] = np.where(hit, count[at], 0)
        return out

    def _numbers(self, kind: str, key: np.ndarray, first: int, columns: int, bits: int) -> np.ndarray:
        out = np.zeros((len(key), columns), np.int64)
        for mine, arrays in self._visit(kind, key, bits):
            names, numbers = arrays[first], arrays[first + 1:]
            if len(names):
                at, hit = _find(names, key[mine])
                for i, n in enumerate(numbers):
                    out[mine, i] = np.where(hit, n[at], 0)
        return out

    def word_counts(self, short: np.ndarray) -> np.ndarray:
        """(tokens after it, types after it seen once, twice, more, types before it) of each of sorted 48-bit words."""
        return self._numbers("word", short, 2, 5, 48)

    def context_counts(self, key: np.ndarray, order: int) -> np.ndarray:
        """(tokens after it, types after it seen once, twice, more) of each of sorted contexts of n-grams of this order."""
        return self._numbers(f"context{order}", key, 0, 4, 64)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, base log10, model log10) of each text."""
        token, counts = tokens(texts)
        word, back = np.unique(token, return_inverse=True)
        c = self.word_tokens(word)[back]
        base = np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))
        columns = windows(token, counts, self.order)
        short, back = np.unique(np.concatenate([columns[-1], [START]]), return_inverse=True)
        number = self.word_counts(short)
        follows = number[:, 4]
        low = np.maximum(follows - self.discounts[1][np.minimum(follows, 3)], 0) / max(1, self.follows) + self.fresh / (self.types + 1)
        p = low[back[:-1]]
        for order in range(2, self.order + 1):
            gram = columns[-order:]
            key, at = np.unique(gram_hash(gram), return_inverse=True)
            n = self.gram_counts(key, order)
            first = (n - self.discounts[order][np.minimum(n, 3)])[at]
            if order == 2:
                after, at = number, np.where(gram[0] == START, back[-1], np.roll(back[:-1], 1))
            else:
                key, at = np.unique(gram_hash(gram[:-1]), return_inverse=True)
                after = self.context_counts(key, order)
            total = after[:, 0]
            share = np.where(total > 0, after[:, 1:4] @ self.discounts[order][1:] / np.maximum(total, 1), 1.0)
            p = first / np.maximum(total[at], 1) + share[at] * p
        begin = np.cumsum(counts) - counts
        sums = [np.add.reduceat(x, begin) for x in ((c > 0).astype(np.int64), base, np.log10(p))]
        return counts, *sums


def train(docs: DataFrame, text: str = "text", shard_tokens: int = SHARD_TOKENS, order: int = ORDER) -> Model:
    """Count all rows' whole texts into a stored model of n-grams up to ``order`` words; null texts are empty.

    Repeated rows count each time. Only a row per shard comes to the driver.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    source = docs.select(whole(text).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-int(size) * order // (2 * BYTES_A_TOKEN * shard_tokens)))
    folder = scratch_folder(spark, "model")

    def apply(fn, *args):
        def run(table: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_blocks(list(fn(table, *args)))])
        return run

    def by_shard(rows: DataFrame, fn, *args) -> DataFrame:
        keys = ["kind", "shard"] if fn is _merge_shard else ["shard"]
        return rows.groupBy(*keys).applyInArrow(apply(fn, folder, *args), BLOCKS)

    sizes: dict[str, dict[int, np.ndarray]] = {}

    def hold(name: str, rows: DataFrame) -> None:
        # A row per shard, a shard being millions of tokens.
        sizes[name] = {r["shard"]: np.frombuffer(bytes(r["numbers"]), "<u8").astype(np.int64) for r in rows.select("shard", "numbers").collect()}

    blocks, merged = source.mapInArrow(_count(shards, order), BLOCKS), []
    for n in range(order, 1, -1):
        merged.append(scratch(by_shard(blocks, _merge_shard, shards, n), "lm-blocks"))
        hold(f"gram{n}", merged[-1].where("kind = 'grams'"))
        if n > 2:
            hold(f"context{n}", by_shard(merged[-1].where("kind = 'long'"), _shard_contexts, n))
        blocks = merged[-1].where("kind = 'gram'")
    counted = reduce(DataFrame.unionByName, merged).where("kind in ('total', 'context', 'follows')")
    hold("word", by_shard(counted, _shard_words))
    for table in merged:
        drop_scratch(table)
    model = Model(folder, shards, order, sizes)
    over_words = sum(sizes["word"].values(), np.zeros(10, np.int64))
    for n in range(2, order + 1):
        model.discounts[n] = discounts(sum(sizes[f"gram{n}"].values(), np.zeros(6, np.int64))[2:])
    model.discounts[1] = discounts(over_words[5:9])
    model.types, model.tokens, model.follows = (int(over_words[i]) for i in (0, 3, 4))
    n1, n2 = over_words[5:7]
    if model.follows:  # every training token follows something
        model.fresh = float(model.discounts[1][1:] @ np.array([n1, n2, over_words[9] - n1 - n2]) / model.follows)
    return model


def _score(shared, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", 2 * PIECE_BYTES):
                n, known, base, own = model.score(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(own)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_tokens, n_known, base_score, score)`` for every row; scores are log10 probabilities.

    Perplexity is ``10 ** (-score / n_tokens)``. A null or empty text is one
    token, its end. A word no training text has gets the model's share for new
    words. Repeated rows get equal scores; an empty table gives no rows; other
    columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")).mapInArrow(
        _score(shared, _ARROW[kind]), f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out(doc_id: str = "doc_id", remainder: int = 1) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` on division by 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == remainder, F.lit(True))
