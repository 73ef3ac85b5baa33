"""Sharding over fixed virtual slots.

A record's hash picks one of a few thousand slots for good. Bytes are summed per slot, and a
versioned map says which shard owns which slot. Rebalancing and growth edit the map: they
reassign slots, so only the records of reassigned slots move. The map has one row per slot,
however large the data is; it is the only thing that the driver ever holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.text import each_copy

SLOTS = 4096


def record_rows(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) per row of ``docs``.

    Size is the text's UTF-8 bytes (null: none) plus 1. The slot depends on doc_id, text and
    the row's number among the rows alike in both, so that many equal rows are spread too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_h"),
    )
    alike = thin.groupBy(*thin.columns).agg(F.count("*").alias("_n"))
    slot = F.pmod(F.xxhash64("doc_id", "_h", "_copy"), F.lit(slots)).cast("int").alias("virtual_slot")
    return each_copy(alike, "_n").select("doc_id", "size", "text_crc32", slot)


@dataclass(frozen=True)
class SlotMap:
    """Version of the assignment; ``shards[slot]`` owns the slot."""

    version: int
    shards: tuple[int, ...]

    def edited(self, changes: dict[int, int]) -> SlotMap:
        return SlotMap(self.version + 1, tuple(changes.get(s, o) for s, o in enumerate(self.shards)))


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Equal runs of slots."""
    return SlotMap(0, tuple(s * shards // slots for s in range(slots)))


def slot_sizes(records: DataFrame) -> dict[int, int]:
    """Bytes per slot that has any; one small row per slot reaches the driver."""
    return {r[0]: r[1] for r in records.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def rebalanced(current: SlotMap, sizes: dict[int, int], shards: int | None = None) -> SlotMap:
    """The next version: slots move from the fullest shard to the emptiest.

    Each move takes the slot whose size is nearest to half the gap, as long as that narrows
    the gap; ties go to the lowest slot. ``shards`` may exceed the map's: new ones start
    empty.
    """
    n = shards or max(current.shards) + 1
    owned: list[dict[int, int]] = [{} for _ in range(n)]
    for slot, shard in enumerate(current.shards):
        if size := sizes.get(slot, 0):
            owned[shard][slot] = size
    load = [sum(o.values()) for o in owned]
    changes: dict[int, int] = {}
    while True:
        high = max(range(n), key=lambda i: (load[i], -i))
        low = min(range(n), key=lambda i: (load[i], i))
        gap = load[high] - load[low]
        fitting = [(abs(2 * size - gap), slot) for slot, size in owned[high].items() if size < gap]
        if not fitting:
            return current.edited(changes)
        slot = min(fitting)[1]
        size = owned[low][slot] = owned[high].pop(slot)
        load[high] -= size
        load[low] += size
        changes[slot] = low


def grown(current: SlotMap, sizes: dict[int, int]) -> SlotMap:
    """The next version with one more shard, which takes its part of each other shard's
    bytes; no slot moves between the old shards."""
    new = max(current.shards) + 1
    share = sum(sizes.values()) / (new + 1)
    load = [0] * new
    for slot, shard in enumerate(current.shards):
        load[shard] += sizes.get(slot, 0)
    changes: dict[int, int] = {}
    for slot in sorted(range(len(current.shards)), key=lambda s: (-sizes.get(s, 0), s)):
        shard, size = current.shards[slot], sizes.get(slot, 0)
        if size and load[shard] - size >= share:
            load[shard] -= size
            changes[slot] = new
    return current.edited(changes)


def store_map(spark: SparkSession, path: str, slot_map: SlotMap) -> None:
    """Append a version to the table of maps."""
    rows = [(slot_map.version, s, o) for s, o in enumerate(slot_map.shards)]
    frame = spark.createDataFrame(rows, "version int, virtual_slot int, shard int")
    frame.coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard) of a version, or of the newest."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version).drop("version")


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds ``shard`` and ``slot``, the record's place in its shard, gapless from 0.

    Places are numbered inside each virtual slot and shifted by the counts of the shard's
    earlier slots, so no shard meets in one task. Order: virtual slot, doc_id, checksum;
    rows alike in all three are interchangeable.
    """
    counts = records.groupBy("virtual_slot").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(F.broadcast(slot_map), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    numbered = records.withColumn("_no", F.row_number().over(inside) - 1)
    # One row per virtual slot: a bounded broadcast.
    placed = numbered.join(F.broadcast(starts), "virtual_slot")
    return placed.withColumn("slot", (F.col("_start") + F.col("_no")).cast("long")).drop("_start", "_no")
