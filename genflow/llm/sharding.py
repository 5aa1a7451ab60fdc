"""Shards by balanced label propagation, in DataFrame operations only.

Documents that share a group are linked. Each round a group's members ask for
the shard where most of the group already is, and shards admit as many as
their quota and those who leave make room for. Unlinked documents then fill
every shard to its exact count; what a shard holds above it goes on by whole
groups. A shard's quota is its share of all rows, so counts differ by one
at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import drop_scratch, scratch, whole

SHARDS = 40
ROUNDS = 8
#: Rows of a stored file that are numbered together.
BLOCK_BITS = 16
#: Groups whose hashes are equal but for so many bits are numbered together.
GROUP_BITS = 52
#: A group over this share of a shard is salted into parts of about that size.
PART_OF_SHARD = 0.25


def _numbered(table: DataFrame) -> DataFrame:
    """A stored table with ``nid``: the part file's number and the row's place in it."""
    file = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return table.select("*", (F.shiftleft(file, 40) + F.col("_metadata.row_index")).alias("nid"))


def _places(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``place``: gapless number of each row inside its key, in order of ``grp``, or of ``nid`` where that is null.

    Rows are numbered inside (key, block), and a group is in one block; one row per (key, block) carries the offsets.
    """
    rows = df.withColumn("_block", F.coalesce(F.shiftright("grp", GROUP_BITS), F.shiftright("nid", BLOCK_BITS)))
    counts = rows.groupBy(key, "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from"))
    inside = F.row_number().over(Window.partitionBy(key, "_block").orderBy("grp", "nid")) - 1
    return (rows.withColumn("_in", inside).join(counts, [key, "_block"])
            .withColumn("place", F.col("_from") + F.col("_in")).drop("_block", "_in", "_from"))


def _chances(flows: dict[tuple[int, int], int], shards: int, capacity: int) -> list[float]:
    """For each shard the greatest share of those asking for it that it can admit.

    ``flows`` are rows by shard and wish. A shard has its free places and those
    of the rows that leave it, which in turn are as many as the others admit:
    shares begin at one and fall until they agree.
    """
    held, demand = [0] * shards, [0] * shards
    moves = [(j, to, n) for (j, to), n in flows.items() if j != to]
    for (j, _), n in flows.items():
        held[j] += n
    for _, to, n in moves:
        demand[to] += n
    chance = [1.0] * shards
    while True:
        leave = [0.0] * shards
        for j, to, n in moves:
            leave[j] += n * chance[to]
        new = [min(c, max(0.0, (capacity - h + out) / d)) if d else c for c, h, out, d in zip(chance, held, leave, demand)]
        if max(c - n for c, n in zip(chance, new)) < 1e-3:
            return new
        chance = new


def propagate(members: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """Shard of each linked node: rows ``(nid, shard)`` for members ``(nid, grp)``.

    A node may be in several groups; it follows the one with most members in
    one shard. Groups, not single nodes, are admitted, by a hash that changes
    with the round, with a chance of room over demand (:func:`_chances`). When
    ``rounds`` are over or no fewer rows ask to move than before, those that
    still do are let in above the quota; ends when nothing moves.
    """
    start = F.pmod(F.xxhash64("nid"), F.lit(shards)).cast("int")
    now = scratch(members.select("nid").distinct().withColumn("shard", start), "shards")
    cut = None
    for round_ in range(rounds + 1):
        votes = members.join(now, "nid").groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
        tie = F.xxhash64("grp", "shard")
        top = scratch(votes.groupBy("grp").agg(F.max(F.struct("n", tie.alias("t"), "shard")).alias("top"))
                      .select("grp", F.col("top.n").alias("votes"), F.col("top.shard").alias("to")), "votes")
        wish = members.join(top, "grp").groupBy("nid").agg(F.max(F.struct("votes", "grp", "to")).alias("w"))
        asked = scratch(now.join(wish, "nid").select("nid", "shard", F.col("w.grp").alias("grp"), F.col("w.to").alias("to")), "asked")
        moving = F.col("shard") != F.col("to")
        # A row per pair of shards at most.
        flows = {(r["shard"], r["to"]): r["n"] for r in asked.groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
        asking = sum(n for (j, to), n in flows.items() if j != to)
        last = round_ == rounds or cut is not None and asking >= cut
        cut = asking
        chance = [1.0] * shards if last else _chances(flows, shards, capacity)
        draw = F.pmod(F.xxhash64("grp", F.lit(round_)), F.lit(1 << 30)) / F.lit(1 << 30)
        admitted = moving & (draw < F.element_at(F.array(*[F.lit(c) for c in chance]), F.col("to") + 1))
        moved = asked.select("nid", F.when(admitted, F.col("to")).otherwise(F.col("shard")).alias("shard"))
        before, now = now, scratch(moved, "shards")
        for done in (before, top, asked):
            drop_scratch(done)
        if last or not asking:
            break
    return now.select("nid", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, text: str = "text",
                    doc_id: str = "doc_id", group: Column | None = None) -> DataFrame:
    """Rows ``(doc_id, size, text_crc32, shard, slot)``; counts of shards at most one apart.

    ``group`` links rows (equal texts by default; null links nothing). A row's
    size is the text's UTF-8 bytes plus 16, a null text has none. Repeated rows
    and null ids are rows of their own; an empty table gives no rows; other
    columns are not carried. Groups too large for a shard are split.
    """
    body = whole(text)
    linked_by = F.xxhash64(body, F.crc32(body.cast("binary"))) if group is None else group
    nodes = _numbered(scratch(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), linked_by.alias("grp")), "nodes"))
    total = nodes.count()
    target = [total // shards + (j < total % shards) for j in range(shards)]
    most = max(2, int(total // shards * PART_OF_SHARD))
    groups = scratch(nodes.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    parts = F.ceil(F.col("n") / F.lit(most))
    members = scratch(nodes.select("nid", "grp").join(groups, "grp").select(
        "nid", F.xxhash64("grp", F.pmod(F.xxhash64("nid"), parts)).alias("grp")), "members")
    placed = propagate(members, shards, total // shards, rounds)
    rows = nodes.drop("grp").join(placed.join(members, "nid"), "nid", "left").withColumn("_at", F.coalesce("shard", F.lit(-1))).drop("shard")
    rows = scratch(_places(rows, "_at"), "places")
    held = {r["_at"]: r["n"] for r in rows.groupBy("_at").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per shard
    free, over, room, base = held.get(-1, 0), [], [], [0]
    for j in range(shards):
        have = held.get(j, 0)
        over.append(free)
        free += max(0, have - target[j])
        room.append(min(have, target[j]))
        base.append(base[-1] + target[j] - room[-1])

    def of(values: list[int], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), (at + 1).cast("int"))

    at, place = F.col("_at"), F.col("place")
    stays = (at >= 0) & (place < of(target, F.greatest(at, F.lit(0))))
    # Rows without a place of their own queue up: unlinked ones, then what a shard could not hold.
    queue = F.when(at < 0, place).otherwise(of(over, F.greatest(at, F.lit(0))) + place - of(target, F.greatest(at, F.lit(0))))
    into = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in base[1:]]), lambda b: b <= F.col("_queue")))
    rows = rows.withColumn("_stays", stays).withColumn("_queue", F.when(stays, F.lit(0)).otherwise(queue))
    rows = rows.withColumn("_to", F.when(F.col("_stays"), at).otherwise(into).cast("int"))
    slot = F.when(F.col("_stays"), place).otherwise(of(room, F.col("_to")) + F.col("_queue") - of(base, F.col("_to")))
    return rows.select("doc_id", "size", "text_crc32", F.col("_to").alias("shard"), slot.cast("long").alias("slot"))
