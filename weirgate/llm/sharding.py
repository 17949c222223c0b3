"""Sharding by fixed virtual slots.

A record's id, its text's checksum and, of rows that are equal in both, its number among them hash into one of SLOTS
virtual slots, for good: a record stays in its slot while its text is the same, and rows that share an id (or have none)
are spread like any others. Bytes are
summed for each slot before any shuffle, and a slot map, a small versioned table, says which shard holds which slot.
Sizes are kept near equal by editing the map: the slots with the most bytes are placed first, each into the emptiest
shard; later edits (rebalance, grow) move single slots and make a new version, so that most rows stay where they are.

Defined results: null text has size 1 and checksum 0; null ids are dealt by their text and number; repeated rows are rows
of their own; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, only

#: Virtual slots; fixed for the life of a data set.
SLOTS = 8192
#: Equal rows that are numbered in one piece.
PIECE = 1024


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds which slot, as of one version."""

    version: int
    shards: int
    owner: tuple[int, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(version, shards, slot, shard): SLOTS small rows."""
        rows = [(self.version, self.shards, s, o) for s, o in enumerate(self.owner)]
        return spark.createDataFrame(rows, "version int, shards int, vslot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the map table; older versions stay readable."""
        self.frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={self.version:010d}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/version={version:010d}").select("shards", "vslot", "shard").collect()
        rows.sort(key=lambda r: r.vslot)
        return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows))

    @staticmethod
    def latest(spark: SparkSession, path: str) -> SlotMap | None:
        """The last version that was written whole, if there is any."""
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
        done = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
        versions = [int(d.getPath().getParent().getName().split("=")[1]) for d in done or ()]
        return SlotMap.load(spark, path, max(versions)) if versions else None


def first_map(slot_bytes: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: the largest slots first, each into the shard with the fewest bytes so far."""
    owner, heap = [0] * slots, [(0, 0, s) for s in range(shards)]
    for slot in sorted(range(slots), key=lambda s: (-slot_bytes.get(s, 0), s)):
        size, n, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (size + slot_bytes.get(slot, 0), n + 1, shard))
    return SlotMap(1, shards, tuple(owner))


def loads(slot_map: SlotMap, slot_bytes: dict[int, int]) -> list[int]:
    """Bytes of each shard."""
    out = [0] * slot_map.shards
    for slot, shard in enumerate(slot_map.owner):
        out[shard] += slot_bytes.get(slot, 0)
    return out


def rebalance(slot_map: SlotMap, slot_bytes: dict[int, int], tolerance: float = 0.01) -> SlotMap:
    """The next version: slots move from the fullest to the emptiest shard while that narrows a gap beyond tolerance."""
    owner, size = list(slot_map.owner), loads(slot_map, slot_bytes)
    mean = sum(size) / len(size)
    while True:
        high, low = max(range(len(size)), key=size.__getitem__), min(range(len(size)), key=size.__getitem__)
        gap = size[high] - size[low]
        moves = [(slot_bytes.get(s, 0), -s) for s, o in enumerate(owner) if o == high and 0 < slot_bytes.get(s, 0) < gap]
        if gap <= tolerance * mean or not moves:
            return SlotMap(slot_map.version + 1, slot_map.shards, tuple(owner))
        moved, slot = min(moves, key=lambda m: abs(2 * m[0] - gap))
        owner[-slot] = low
        size[high] -= moved
        size[low] += moved


def grow(slot_map: SlotMap, slot_bytes: dict[int, int]) -> SlotMap:
    """The next version, with one more shard; slots move only into it, from whichever shard is fullest."""
    owner, size, new = list(slot_map.owner), loads(slot_map, slot_bytes), slot_map.shards
    goal, got = sum(size) / (new + 1), 0
    held = {s: sorted((x for x in range(len(owner)) if owner[x] == s), key=lambda x: (slot_bytes.get(x, 0), -x)) for s in range(new)}
    heap = [(-size[s], s) for s in range(new)]
    heapq.heapify(heap)
    while heap:
        room, shard = heapq.heappop(heap)
        while held[shard] and got + slot_bytes.get(held[shard][-1], 0) > goal:
            held[shard].pop()
        if not held[shard] or -room <= goal:
            continue
        slot = held[shard].pop()
        owner[slot] = new
        got += slot_bytes.get(slot, 0)
        heapq.heappush(heap, (room + slot_bytes.get(slot, 0), shard))
    return SlotMap(slot_map.version + 1, new + 1, tuple(owner))


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot); only these leave the scan, the texts stay."""
    text = F.col("text").cast("string")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = only(docs, "doc_id", "text").select("doc_id", size.alias("size"), crc.cast("long").alias("text_crc32"))
    # Equal rows meet as a count, which is dealt out again in pieces, so that a frequent row is no single task's.
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    pieces = counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PIECE))))
    pieces = pieces.repartition("doc_id", "text_crc32", "piece")
    first = F.col("piece") * PIECE
    numbered = pieces.withColumn("number", F.explode(F.sequence(first, F.least(first + PIECE, F.col("n")) - 1)))
    key = F.xxhash64("doc_id", "text_crc32", "number")
    return numbered.select("doc_id", "size", "text_crc32", F.pmod(key, F.lit(slots)).cast("int").alias("vslot"))


def kept_map(spark: SparkSession, path: str, slot_bytes: dict[int, int], shards: int) -> SlotMap:
    """The map table's last version, edited where shards were added or bytes drifted apart; every new version is saved."""
    found = SlotMap.latest(spark, path)
    if found is None:
        # Edited at once as later runs would, so that they leave it alone while the bytes are the same.
        found = replace(rebalance(first_map(slot_bytes, shards), slot_bytes), version=1)
        found.save(spark, path)
    if shards < found.shards:
        raise ValueError(f"the slot map at {path} has {found.shards} shards; slots can't move into {shards}")
    while found.shards < shards:
        found = grow(found, slot_bytes)
        found.save(spark, path)
    edited = rebalance(found, slot_bytes)
    if edited.owner != found.owner:
        edited.save(spark, path)
        found = edited
    return found


def place(docs: DataFrame, shards: int = 16, slot_map: SlotMap | None = None, maps: str | None = None) -> DataFrame:
    """Every row's shard, and its place in that shard, gapless from 0.

    maps is the data set's map table: its last version is loaded and edited, or its first one made and saved. Without it
    and slot_map, a map is planned for this table alone, from the bytes of the slots, and not kept. A place is the number of rows in the shard's
    earlier slots plus the row's number in its own slot, so no task numbers a whole shard.
    """
    spark = docs.sparkSession
    rows = materialize(slotted(docs), "shard-rows")
    stats = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()  # at most SLOTS rows
    slot_bytes, counts = {r.vslot: r.bytes for r in stats}, {r.vslot: r.n for r in stats}
    slot_map = slot_map or (kept_map(spark, maps, slot_bytes, shards) if maps else first_map(slot_bytes, shards))
    start, firsts = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.owner):
        firsts.append((slot, shard, start[shard]))
        start[shard] += counts.get(slot, 0)
    firsts = spark.createDataFrame(firsts, "vslot int, shard int, before long")
    number = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    placed = rows.withColumn("rank", number).join(F.broadcast(firsts), "vslot")  # SLOTS rows
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"), "vslot", F.lit(slot_map.version).alias("map_version"))
