"""Best-fit packing by sums of squares.

A piece goes where the sum, over residual gaps, of the squared number of open
sequences becomes smallest. Pieces are spread over tasks and placed longest
first; what a task leaves open is merged by the same rule in ever fewer tasks.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import scratch, whole

CAPACITY = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"
#: Pieces or open sequences that one merging task takes.
MERGE_ROWS = 200_000
# A sequence is named by merging round, task (24 bits) and number in the task (36 bits).
PART_BITS, NUMBER_BITS = 24, 36


_NEVER = np.iinfo(np.int64).max


class Squares:
    """Open sequences by gap, and the placement rule.

    Putting length s in a sequence of gap g changes the sum of squares by
    2(N[g-s] - N[g]) + 2, or by 1 - 2N[g] if it fills it. A new sequence is
    begun only where none fits; ties go to the fullest.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[deque] = [deque() for _ in range(capacity + 1)]
        self.begun = 0

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``length``."""
        cap, counts, gap = self.capacity, self.counts, 0
        if length < cap:
            have = counts[length:cap]
            change = 2 * (counts[:cap - length] - have) + 2
            change[0] = 1 - 2 * have[0]
            change[have == 0] = _NEVER
            at = int(np.argmin(change))
            gap = at + length if change[at] < _NEVER else 0
        if gap:
            sequence, left, offset = self.open[gap].popleft(), gap - length, cap - gap
            counts[gap] -= 1
        else:
            sequence, left, offset = self.begun, cap - length, 0
            self.begun += 1
        if left:
            self.open[left].append(sequence)
            counts[left] += 1
        return sequence, offset


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` ids: full ones, the first takes the remainder."""
    rest = n % capacity
    starts = ([0] if rest else []) + list(range(rest, n, capacity))
    return [(a, rest if a == 0 and rest else capacity) for a in starts]


class Ids:
    """The tokenizer's ids, by the same vocabulary's rank table where that is faster.

    Both files hold one byte-level BPE vocabulary. A text with the special
    token's string goes to ``tokenizers``, which makes it one id.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(json_path)

    def __call__(self, text: str) -> list[int]:
        if SPECIAL in text:
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


_IDS: dict[tuple[str, str], Ids] = {}


def tokenizer(json_path: str | None = None, ranks_path: str | None = None) -> Ids:
    import public_tokenizers

    key = (json_path or public_tokenizers.path("byte_bpe_50k.json"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    if key not in _IDS:
        _IDS[key] = Ids(*key)
    return _IDS[key]


PIECES = (
    "doc_id {id}, piece int, start long, length long, ids_crc32 long, part long, bin long{ids}")


def _tokenize(capacity: int, json_path: str | None, ranks_path: str | None, with_ids: bool, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, ids_of, made = TaskContext.get().partitionId(), tokenizer(json_path, ranks_path), 0
        for batch in batches:
            rows: list[list] = [[] for _ in range(7 + with_ids)]
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = np.array([*ids_of(text.as_py()), END_ID], "<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    here = ids[start:start + length]
                    row = [doc.as_py(), number, start, length, zlib.crc32(here.tobytes()), part, made]
                    made += 1
                    for column, value in zip(rows, [*row, here.tolist()] if with_ids else row):
                        column.append(value)
            kinds = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "bin", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names[:len(rows)])
    return run


def _merge(capacity: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, squares = (level << PART_BITS) + TaskContext.get().partitionId(), Squares(capacity)
        for batch in batches:
            put = [squares.place(fill.as_py()) for fill in batch.column("fill")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("bin"), pa.array([p[0] for p in put], pa.int64()),
                 pa.array([p[1] for p in put], pa.int64()), pa.array([part] * len(put), pa.int64()), batch.column("fill")],
                names=["part", "bin", "to_bin", "shift", "to_part", "fill"])
    return run


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY,
         json_path: str | None = None, ranks_path: str | None = None, with_ids: bool = False,
         merge_rows: int = MERGE_ROWS) -> DataFrame:
    """Pieces of all documents with their place in sequences of ``capacity`` ids.

    A document is its ids and an end id; a null text is empty (one end id).
    Repeated rows are packed each; a null doc_id stays null; other columns are
    not carried. An empty table gives no rows. ``with_ids`` adds the ids.

    The tokenized pieces are stored once, so that a lost executor cannot place
    a piece twice. Each begins as its own sequence; these go, longest first, through tasks of
    ``merge_rows``; rounds end when one task took all or a round saved nothing.
    """
    kind = docs.schema[doc_id].dataType
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    schema = PIECES.format(id=kind.simpleString(), ids=", ids array<int>" if with_ids else "")
    pieces = scratch(docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")).mapInArrow(
        _tokenize(capacity, json_path, ranks_path, with_ids, id_type), schema), "pieces")
    now = pieces.where(F.col("length") < capacity).select("part", "bin", F.col("length").alias("fill"))
    left, where, level = now.count(), None, 0
    while left > 1:
        tasks, level = -(-left // merge_rows), level + 1
        # Range partitions by a hash mix the lengths of all tasks; inside, long ones first.
        spread = now.select("part", "bin", "fill", F.xxhash64("part", "bin").alias("_h"))
        ordered = (spread.coalesce(1) if tasks == 1 else spread.repartitionByRange(tasks, "_h")).sortWithinPartitions(
            F.desc("fill"), "_h", "part", "bin").drop("_h")
        step = scratch(ordered.mapInArrow(_merge(capacity, level), "part long, bin long, to_bin long, shift long, to_part long, fill long"), "merge")
        if where is None:
            where = step.select("part", "bin", "to_part", "to_bin", "shift")
        else:
            hop = step.select(F.col("part").alias("to_part"), F.col("bin").alias("to_bin"), F.col("to_part").alias("p2"),
                              F.col("to_bin").alias("b2"), F.col("shift").alias("s2"))
            where = scratch(where.join(hop, ["to_part", "to_bin"], "left").select(
                "part", "bin", F.coalesce("p2", "to_part").alias("to_part"), F.coalesce("b2", "to_bin").alias("to_bin"),
                (F.col("shift") + F.coalesce("s2", F.lit(0))).alias("shift")), "where")
        after = step.groupBy(F.col("to_part").alias("part"), F.col("to_bin").alias("bin")).agg(F.sum("fill").alias("fill"))
        now = scratch(after.where(F.col("fill") < capacity), "open")
        before, left = left, now.count()
        if tasks == 1 or left > 0.95 * before:
            break
    if where is None:
        placed = pieces.select("*", F.lit(0).cast("long").alias("shift"), F.col("part").alias("to_part"), F.col("bin").alias("to_bin"))
    else:
        placed = pieces.join(where, ["part", "bin"], "left")
    task, number = F.coalesce("to_part", "part"), F.coalesce("to_bin", "bin")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.shiftleft(task, NUMBER_BITS) + number).alias("sequence_id"),
        F.coalesce("shift", F.lit(0).cast("long")).alias("offset"), *(["ids"] if with_ids else []))
