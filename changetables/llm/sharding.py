"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into thousands of slots. Bytes are summed by slot, and a map with one
row per slot says which shard holds it. Rebalancing edits the map: it moves as few slots
as it can and writes the result as the next version. The map is bounded by the number of
slots, so it may pass through the driver; the records never do.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changetables.llm.common import BROADCAST_BYTES
from changetables.session import materialise

SLOTS = 4096
MAP_SCHEMA = "version int, slot int, part int, parts int, shard int"


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: by its key, or by its text where the key is null."""
    return F.pmod(F.when(key.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(key)), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame, by: list[str], size: str = "size") -> DataFrame:
    """Bytes and rows of every slot, or slot part, that has records; sums combine before the shuffle."""
    return records.groupBy(*by).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n"))


SlotMap = dict[tuple[int, int], tuple[int, int]]


def first_map(slots: int, shards: int) -> SlotMap:
    """Version 0: (slot, part) -> (parts, shard), slots in equal ranges, one part each."""
    return {(s, 0): (1, s * shards // slots) for s in range(slots)}


def cut(current: SlotMap, sizes: dict[int, tuple[int, int]], shards: int) -> SlotMap:
    """``current`` with large slots in parts, so that a key with any share of the rows can be spread.

    A slot of more than 1/64 of a shard's fair share gets a part for each such share, but
    no more parts than rows; new parts start where the slot's first part is.
    """
    unit = max(sum(b for b, _ in sizes.values()) / shards / 64, 1.0)
    out = {}
    for (slot, part), (parts, shard) in current.items():
        size, n = sizes.get(slot, (0, 0))
        count = max(parts, int(min(n, -(-size // unit))) if size > unit else 1)
        out[slot, part] = (count, shard)
        if part == 0:
            out.update({(slot, p): (count, shard) for p in range(parts, count)})
    return out


def rebalance(current: SlotMap, sizes: dict[tuple[int, int], int], shards: int) -> SlotMap:
    """The next map: shards of near-equal bytes, with few slots moved.

    Slots leave each shard above its fair share, largest first, and all slots of shards
    that are no more; they go to the emptiest shards. At last the fullest shard passes
    single slots to the emptiest until no slot narrows the gap.
    """
    fair = sum(sizes.values()) / shards
    held: dict[int, list[tuple[int, tuple[int, int]]]] = defaultdict(list)
    load = [0] * shards
    homeless: list[tuple[int, tuple[int, int]]] = []
    for key, (_, shard) in sorted(current.items()):
        item = (sizes.get(key, 0), key)
        (held[shard] if shard < shards else homeless).append(item)
        if shard < shards:
            load[shard] += item[0]
    for shard in range(shards):
        kept = []
        for item in sorted(held[shard], reverse=True):
            if item[0] and load[shard] - item[0] >= fair:
                load[shard] -= item[0]
                homeless.append(item)
            else:
                kept.append(item)
        held[shard] = kept
    heap = [(load[s], s) for s in range(shards)]
    heapq.heapify(heap)
    for item in sorted(homeless, key=lambda x: (-x[0], x[1])):
        bytes_, shard = heapq.heappop(heap)
        held[shard].append(item)
        load[shard] = bytes_ + item[0]
        heapq.heappush(heap, (load[shard], shard))
    for _ in range(8 * shards):
        top, low = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap = load[top] - load[low]
        want = min(sorted(held[top]), key=lambda x: abs(x[0] - gap / 2), default=(0, (0, 0)))
        if not 0 < want[0] < gap:
            break
        held[top].remove(want)
        held[low].append(want)
        load[top], load[low] = load[top] - want[0], load[low] + want[0]
    return {key: (current[key][0], shard) for shard, items in held.items() for _, key in items}


def write_map(spark: SparkSession, folder: str, version: int, slot_map: dict) -> DataFrame:
    """Store a version of the map; earlier versions stay readable beside it."""
    rows = [(version, slot, part, parts, shard) for (slot, part), (parts, shard) in sorted(slot_map.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/map-{version:06d}")
    return read_map(spark, folder, version)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/map-{version:06d}")


def _in_parts(records: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``records`` with the part of their slot; only slots in several parts are looked up."""
    many = [(slot, parts) for (slot, part), (parts, _) in sorted(slot_map.items()) if part == 0 and parts > 1]
    cuts = records.sparkSession.createDataFrame(many, "slot int, parts int")
    part = F.pmod(F.xxhash64("row_id"), F.coalesce("parts", F.lit(1))).cast("int")
    return records.join(F.broadcast(cuts), "slot", "left").withColumn("part", part).drop("parts")


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` (row_id, slot, part, ...) with ``shard`` and ``place``, gapless from 0 in each shard.

    The map has at most slots + 64 x shards + shards rows of 20 bytes, checked before it is
    broadcast. Rows are numbered inside each slot part; a part's first number is the count
    of the shard's parts before it, so no task holds a shard.
    """
    if slot_map.count() * 64 > BROADCAST_BYTES:
        raise ValueError("the slot map is larger than any map of this module")
    placed = records.join(F.broadcast(slot_map.select("slot", "part", "shard")), ["slot", "part"])
    counts = placed.groupBy("shard", "slot", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("slot", "part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("slot", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("slot", "part").orderBy("row_id")
    return (
        placed.join(F.broadcast(starts), ["slot", "part"])
        .withColumn("place", (F.col("start") + F.row_number().over(within) - 1).cast("long"))
        .drop("start")
    )


def shard_by_slots(
    docs: DataFrame, shards: int, folder: str, slots: int = SLOTS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: key, size, text_crc32, slot, part, shard and place.

    Size is the UTF-8 bytes of the text (null: none) plus 1. The map's first version has
    equal ranges of slots; the second, written to the same folder, follows the bytes.
    Repeated rows are placed one by one; rows with one key share a slot, which is cut into
    parts when it is large. Only these narrow columns are shuffled, never the texts.
    """
    spark = docs.sparkSession
    records = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(F.col(key), F.col(text), slots).alias("slot"),
    )
    records = materialise(records, "shard-records")
    by_slot = {r["slot"]: (r["bytes"], r["n"]) for r in slot_bytes(records, ["slot"]).collect()}
    first = cut(first_map(slots, shards), by_slot, shards)
    write_map(spark, folder, 0, first)
    records = _in_parts(records, first)
    by_part = {(r["slot"], r["part"]): r["bytes"] for r in slot_bytes(records, ["slot", "part"]).collect()}
    return place(records, write_map(spark, folder, 1, rebalance(first, by_part, shards)))
