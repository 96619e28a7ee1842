"""Sharding over fixed virtual slots.

Records are hashed by key into a fixed number of slots (thousands, whatever the data), bytes and rows
are added up per slot, and a slot-to-shard map is made from these sums: slots in falling order of
bytes, each to the shard with fewest bytes so far. The map is a versioned table; growing or
rebalancing writes a new version in which only the edited slots have moved, so old readers keep
theirs. Only per-slot sums (at most ``SLOTS`` rows) reach the driver, and no text is shuffled.

Law: ``bytes`` (the shards' bytes are near equal). A null text has size 1; a null key is hashed as
the empty text; repeated rows share a slot and are numbered one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldguard.session import settle, shared_dir

SLOTS, SHARDS = 4096, 16
# Rows that are numbered in one sort.
ROWS_PER_SORT = 1_000_000
_MAP = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
    ]
)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % slots).cast("int")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot: all that later steps need, without the text."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        slot_of(F.col("doc_id"), slots).alias("virtual_slot"),
    )


def slot_bytes(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows by slot; at most as many entries as there are slots."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size"), F.count("*"))
    return {r[0]: (r[1], r[2]) for r in sums.collect()}


def plan(sizes: dict[int, int], slots: int = SLOTS, shards: int = SHARDS) -> dict[int, int]:
    """A first map: large slots first, each to the shard with fewest bytes (ties: smaller number)."""
    load = [0] * shards
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        shard = load.index(min(load))
        out[slot] = shard
        load[shard] += sizes.get(slot, 0)
    return out


def rebalance(
    current: dict[int, int], sizes: dict[int, int], shards: int
) -> dict[int, int]:
    """Slots to move, and where to: few slots, until no single move evens the shards any more.

    ``shards`` may be larger than before (new shards begin empty).
    """
    load = [0] * shards
    own: dict[int, list[int]] = {s: [] for s in range(shards)}
    for slot, shard in current.items():
        load[shard] += sizes.get(slot, 0)
        own[shard].append(slot)
    moved: dict[int, int] = {}
    while True:
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        fits = [s for s in own[high] if 0 < sizes.get(s, 0) < gap]
        if not fits:
            return moved
        # The slot that leaves the two shards most even.
        slot = min(fits, key=lambda s: (abs(gap - 2 * sizes[s]), s))
        if abs(gap - 2 * sizes[slot]) >= gap:
            return moved
        own[high].remove(slot)
        own[low].append(slot)
        load[high] -= sizes[slot]
        load[low] += sizes[slot]
        moved[slot] = low


@dataclass
class SlotMap:
    """The stored map: a folder of numbered versions, each the edits to the one before."""

    spark: SparkSession
    path: str

    @classmethod
    def create(cls, spark: SparkSession, first: dict[int, int], path: str | None = None) -> SlotMap:
        made = cls(spark, path or f"{shared_dir(spark).rstrip('/')}/slot-map-{uuid4().hex}")
        made._write(0, first)
        return made

    def _write(self, version: int, edits: dict[int, int]) -> None:
        rows = [(version, slot, shard) for slot, shard in sorted(edits.items())]
        table = self.spark.createDataFrame(rows, _MAP)
        # A version is written once: a second writer of the same number fails instead of mixing.
        table.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/v{version:06d}")

    def edit(self, edits: dict[int, int]) -> int:
        version = self.latest() + 1
        self._write(version, edits)
        return version

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(_MAP).parquet(f"{self.path}/v*")

    def latest(self) -> int:
        return self._rows().agg(F.max("version")).first()[0]

    def at(self, version: int | None = None) -> DataFrame:
        """slot, shard as of a version (default: the latest); as many rows as slots."""
        rows = self._rows()
        if version is not None:
            rows = rows.where(F.col("version") <= version)
        last = rows.groupBy("slot").agg(F.max(F.struct("version", "shard")).alias("x"))
        return last.select("slot", F.col("x.shard").alias("shard"))


def assign(records: DataFrame, slot_map: DataFrame, rows_per_slot: int) -> DataFrame:
    """Adds ``shard`` and ``slot``, the place in the shard: gapless from 0.

    Places are counted per virtual slot and, where slots are large, per part of a slot, so that no
    sort holds a shard.
    """
    parts = max(1, -(-rows_per_slot // ROWS_PER_SORT))
    placed = records.join(
        F.broadcast(slot_map.withColumnRenamed("slot", "virtual_slot")), "virtual_slot"
    ).withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)))
    keys = ["shard", "virtual_slot", "part"]
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part")
    base = placed.groupBy(*keys).count()
    base = base.withColumn("base", F.sum("count").over(before) - F.col("count")).drop("count")
    within = Window.partitionBy(*keys).orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(within) - 1)
    return numbered.join(base, keys).withColumn("slot", F.col("base") + F.col("nth")).drop(
        "base", "nth", "part"
    )


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, map_version, shard, slot."""
    records = settle(sized(docs, slots))
    sums = slot_bytes(records)
    first = plan({s: b for s, (b, _) in sums.items()}, slots, shards)
    stored = SlotMap.create(docs.sparkSession, first)
    largest = max([n for _, n in sums.values()], default=0)
    out = assign(records, stored.at(0), largest)
    return out.withColumn("map_version", F.lit(0))
