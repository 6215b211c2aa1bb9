"""Shards by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgersieve.llm.shared import written

VIRTUAL_SLOTS = 8192
ROW_BYTES = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def sized(docs: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of each row.

    Size is the UTF-8 bytes of the text (null: none) plus 16. The slot is a hash of the id and of the text's crc32,
    so rows that repeat an id with other texts spread, and a null id is as good as any. Other columns are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot: at most as many rows as there are slots."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def assign(loads: dict[int, int], shards: int) -> dict[int, int]:
    """Slot to shard: the heaviest slot first, each to the lightest shard (ties: lower numbers first)."""
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for slot in sorted(loads, key=lambda s: (-loads[s], s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + loads[slot], shard))
    return out


def rebalanced(old: dict[int, int], loads: dict[int, int], shards: int) -> dict[int, int]:
    """Edit a map for new loads or another number of shards, moving few slots.

    Slots of shards that no longer exist, and slots the map does not have, go to the lightest shards. Then the
    heaviest shard gives the lightest one a slot as long as that narrows their gap.
    """
    out = {slot: shard for slot, shard in old.items() if shard < shards}
    held: dict[int, int] = dict.fromkeys(range(shards), 0)
    for slot, shard in out.items():
        held[shard] += loads.get(slot, 0)
    for slot in sorted((s for s in loads if s not in out), key=lambda s: (-loads[s], s)):
        out[slot] = min(held, key=lambda k: (held[k], k))
        held[out[slot]] += loads[slot]
    own: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    for slot, shard in out.items():
        own[shard].append(slot)
    for _ in range(len(out)):
        high, low = max(held, key=lambda k: (held[k], -k)), min(held, key=lambda k: (held[k], k))
        gap = held[high] - held[low]
        fits = [s for s in own[high] if 0 < loads.get(s, 0) < gap]
        if not fits:
            break
        slot = min(fits, key=lambda s: (abs(gap - 2 * loads[s]), s))
        own[high].remove(slot)
        own[low].append(slot)
        out[slot] = low
        held[high] -= loads[slot]
        held[low] += loads[slot]
    return out


def store_map(spark: SparkSession, folder: str, version: int, slots: dict[int, int]) -> None:
    """Add a version of the map. Versions that are there are never changed."""
    spark.createDataFrame([(version, s, k) for s, k in sorted(slots.items())], MAP_SCHEMA).coalesce(1).write.mode(
        "errorifexists"
    ).parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}")


def place(rows: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Add each row's shard and its place there, without gaps from 0.

    The place is the rows of the shard's lower slots plus the rank in the own slot (by id, crc32, size), so no task
    ranks more than one slot. The map and the loads have one row a slot and are sent to every task. Equal rows
    (same id and text) share a slot and take places next to each other.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = loads.join(slot_map.select("virtual_slot", "shard"), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("rank", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("place", F.col("first") + F.col("rank"))
        .drop("first", "rank")
    )


def shard_documents(
    docs: DataFrame, folder: str, shards: int, slots: int = VIRTUAL_SLOTS, version: int = 1
) -> DataFrame:
    """Shard all rows so that the shards' bytes are near equal; an empty table gives no rows.

    Stores the first version of the slot-to-shard map in ``folder``; ``rebalanced`` and ``store_map`` add others.
    """
    spark = docs.sparkSession
    rows = written(sized(docs, slots), "shard-sizes")
    loads = written(slot_loads(rows), "shard-loads")
    store_map(spark, folder, version, assign({r.virtual_slot: r.bytes for r in loads.collect()}, shards))
    return place(rows, read_map(spark, folder, version), loads)


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, slots: int = VIRTUAL_SLOTS) -> None:
    """Write whole rows as Parquet, one folder a shard; AQE splits and merges the files."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.crc32(text)), F.lit(slots)).cast("int")
    (
        docs.drop("virtual_slot", "shard")
        .withColumn("virtual_slot", slot)
        .join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")
        .hint("rebalance", "shard")
        .write.partitionBy("shard")
        .parquet(path)
    )


def law() -> Column:
    return F.lit("bytes")
