"""Shards by fixed virtual slots and a versioned map from slots to shards.

A record's slot depends on its id and text alone and never changes. What changes is the map: each edit is
a new version, and only the records of the slots it moves go elsewhere. Balancing works on the
bytes of each slot, a table whose size is the number of slots whatever the number of records.
"""

import heapq
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bidscope.llm.registry import query, table
from bidscope.session import scratch_path

SLOTS = 4096
#: Rows of a slot are numbered in this many parts, so that a slot is never ordered by one task.
PARTS = 8
SHARDS = 16
#: Loads are even when the fullest and the emptiest shard differ by less than this share of the mean.
EVEN = 1e-4


@dataclass(frozen=True)
class SlotMap:
    """Which shard owns each slot. ``moved`` lists the slots that the last edit moved."""

    version: int
    shards: int
    owner: tuple[int, ...]
    moved: tuple[int, ...] = field(default=())

    def loads(self, sizes) -> list[int]:
        loads = [0] * self.shards
        for slot, shard in enumerate(self.owner):
            loads[shard] += sizes.get(slot, 0)
        return loads

    def edited(self, moves: dict[int, int], shards: int | None = None) -> "SlotMap":
        owner = tuple(moves.get(slot, shard) for slot, shard in enumerate(self.owner))
        return SlotMap(self.version + 1, shards or self.shards, owner, tuple(sorted(moves)))

    def rebalanced(self, sizes, tolerance: float = 0.01) -> "SlotMap":
        """Move slots from the fullest to the emptiest shard while that evens them out."""
        loads, moves, owner = self.loads(sizes), {}, list(self.owner)
        held = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(owner):
            held[shard].append((sizes.get(slot, 0), slot))
        for slots in held:
            slots.sort()
        target = sum(loads) / self.shards
        while True:
            most, least = max(range(self.shards), key=loads.__getitem__), min(range(self.shards), key=loads.__getitem__)
            gap = loads[most] - loads[least]
            fits = [x for x in held[most] if 0 < x[0] <= gap / 2] or [x for x in held[most] if 0 < x[0] < gap][:1]
            if gap <= tolerance * target or not fits:
                return self.edited({s: o for s, o in moves.items() if o != self.owner[s]})
            size, slot = fits[-1]
            held[most].remove((size, slot))
            held[least] = sorted([*held[least], (size, slot)])
            loads[most] -= size
            loads[least] += size
            moves[slot] = least

    def grown(self, sizes) -> "SlotMap":
        """One more shard, filled from the fullest ones; no slot moves between old shards."""
        target, new = sum(sizes.values()) / (self.shards + 1), self.shards
        heap = [(-load, shard) for shard, load in enumerate(self.loads(sizes))]
        heapq.heapify(heap)
        held = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(self.owner):
            held[shard].append((sizes.get(slot, 0), slot))
        for slots in held:
            slots.sort(reverse=True)
        moves, taken = {}, 0
        while heap:
            load, shard = heap[0]
            room = [x for x in held[shard] if 0 < x[0] <= target - taken]
            if -load <= target or not room:
                heapq.heappop(heap)
                continue
            size, slot = room[0]
            held[shard].remove((size, slot))
            heapq.heapreplace(heap, (load + size, shard))
            moves[slot], taken = new, taken + size
        return self.edited(moves, self.shards + 1)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(slot, shard) for slot, shard in enumerate(self.owner)]
        return spark.createDataFrame(rows, "virtual_slot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the maps stored in ``path``; an earlier one is never changed."""
        moved = set(self.moved)
        rows = [(slot, shard, self.shards, slot in moved) for slot, shard in enumerate(self.owner)]
        frame = spark.createDataFrame(rows, "virtual_slot int, shard int, shards int, moved boolean")
        frame.coalesce(1).write.mode("error").parquet(f"{path}/version={self.version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the newest by default."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    rows = sorted(maps.filter(F.col("version") == version).collect(), key=lambda r: r["virtual_slot"])
    moved = tuple(r["virtual_slot"] for r in rows if r["moved"])
    return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows), moved)


def first_map(sizes, shards: int = SHARDS, slots: int = SLOTS) -> SlotMap:
    """Version 0: the largest slot first, each to the shard with the fewest bytes so far."""
    heap = [(0, 0, shard) for shard in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, count, shard = heap[0]
        owner[slot] = shard
        heapq.heapreplace(heap, (load + sizes.get(slot, 0), count + 1, shard))
    return SlotMap(0, shards, tuple(owner))


def virtual_slot(key: Column, slots: int = SLOTS, text: Column | None = None) -> Column:
    """The slot of a key, or of a key with a text; null keys without texts share one slot."""
    parts = [key] if text is None else [key, text]
    return F.pmod(F.xxhash64(F.lit("slot"), *parts), F.lit(slots)).cast("int")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def slot_sizes(records: DataFrame, slot: str = "virtual_slot", size: str = "size") -> dict[int, int]:
    """Bytes per slot: at most one row per slot comes to the driver."""
    return {r[0]: r[1] for r in records.groupBy(slot).agg(F.sum(size)).collect()}


def assign(
    docs: DataFrame, slot_map: SlotMap | None = None, shards: int = SHARDS, keep: list[str] | tuple = ("doc_id",)
) -> DataFrame:
    """The columns to keep, and size, text_crc32, virtual_slot, shard and slot of every row.

    ``slot`` numbers the rows of a shard from 0 without gaps. Without a map, one is made from the
    bytes of this table. Every row gets a place: rows equal in id and text stay together, those of
    one id or of none with different texts are dealt out, null and empty texts weigh one byte. Ties in id are ordered by checksum and
    size; rows equal in all three are interchangeable. An empty table gives an empty result.
    Kept columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    added = ("size", "text_crc32", "virtual_slot", "shard", "slot")
    kept = [c for c in keep if c not in added]
    rows = docs.select(
        F.struct(*kept).alias("_row"),
        F.col("doc_id").alias("_id"),
        text_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), len(slot_map.owner) if slot_map else SLOTS, F.col("text")).alias("virtual_slot"),
        F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text"), F.lit(PARTS)).cast("int").alias("_part"),
    )
    counted = rows.groupBy("virtual_slot", "_part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    parts = sorted(counted.collect())  # at most slots x PARTS rows
    sizes: dict[int, int] = {}
    for slot, _, _, size in parts:
        sizes[slot] = sizes.get(slot, 0) + size
    chosen = slot_map or first_map(sizes, shards)
    begins, places = [0] * chosen.shards, []
    for slot, part, n, _ in parts:
        shard = chosen.owner[slot]
        places.append((slot, part, shard, begins[shard]))
        begins[shard] += n
    placed = spark.createDataFrame(places, "virtual_slot int, _part int, shard int, _begin long")
    order = W.partitionBy("virtual_slot", "_part").orderBy("_id", "text_crc32", "size")
    numbered = rows.withColumn("_n", F.row_number().over(order).cast("long") - 1)
    return numbered.join(F.broadcast(placed), ["virtual_slot", "_part"]).select(
        *[F.col("_row")[c].alias(c) for c in kept],
        "size",
        "text_crc32",
        "virtual_slot",
        "shard",
        (F.col("_begin") + F.col("_n")).alias("slot"),
    )


def write_shards(docs: DataFrame, slot_map: SlotMap, path: str) -> None:
    """Write whole rows in folders ``shard=…``, each in as many files as writing tasks hold it."""
    placed = docs.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), len(slot_map.owner), F.col("text")))
    owners = F.broadcast(slot_map.frame(docs.sparkSession))
    placed.join(owners, "virtual_slot").repartition("virtual_slot").write.partitionBy("shard").parquet(path)


def balanced_map(docs: DataFrame, path: str, shards: int = SHARDS) -> SlotMap:
    """The newest map in ``path`` after evening out the bytes of ``docs``, which becomes a version of its own.

    Where there is no map yet, version 0 gives each shard as many slots.
    """
    spark = docs.sparkSession
    slots = virtual_slot(F.col("doc_id"), text=F.col("text")).alias("virtual_slot")
    sizes = slot_sizes(docs.select(slots, text_bytes(F.col("text")).alias("size")))
    try:
        newest = load_map(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = first_map({}, shards)
        newest.save(spark, path)
    newest.rebalanced(sizes, EVEN).save(spark, path)
    return load_map(spark, path)


@query("op9_sharding")
def sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    slot_map = balanced_map(docs, scratch_path(spark, "slot-maps"))
    return assign(docs, slot_map).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
