"""Sharding by fixed virtual slots.

A record belongs to one of thousands of virtual slots by the hash of its id, for ever. A slot map says which shard has which
slot; it is a table of versions. Another number of shards, or a better balance, is an edit of the map: only the slots that it
hands over move. Rows and bytes are aggregated by slot, so that every decision is made on a few thousand numbers.

Two laws can be held. By ``key``, id and number of shards alone decide, and a further shard takes slots only into itself
(:meth:`SlotMap.grown`). By ``bytes``, :func:`rebalanced` hands slots over until the shards' bytes are near equal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.ranks import hex_digits, radix_ranks, row_digits
from millrace.plans.publish import VersionedTables
from millrace.plans.staging import Scratch

SLOTS = 4096
#: Slots that a map may have: it is sent to every executor, at some 50 bytes a slot.
MOST_SLOTS = 1 << 16
#: Bytes that a record counts for besides its text.
RECORD_BYTES = 16


@dataclass(frozen=True)
class SlotMap:
    """``owners``: the shard of each virtual slot."""

    shards: int
    owners: tuple[int, ...]

    def __post_init__(self):
        if not 1 <= len(self.owners) <= MOST_SLOTS:
            raise ValueError(f"a map has 1 to {MOST_SLOTS} slots")
        if not 1 <= self.shards <= len(self.owners) or any(not 0 <= s < self.shards for s in self.owners):
            raise ValueError("every slot belongs to one of the shards, and there are no more shards than slots")

    @classmethod
    def even(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        """The map that one shard with all slots becomes by growing, shard by shard."""
        made = cls(1, (0,) * slots)
        while made.shards < shards:
            made = made.grown()
        return made

    def counts(self) -> list[int]:
        out = [0] * self.shards
        for shard in self.owners:
            out[shard] += 1
        return out

    def grown(self) -> SlotMap:
        """One more shard: the others keep their first slots, as many as are their share, and it takes the rest.

        No slot moves between old shards. Shares differ by one at most; so do the counts of maps made by :meth:`even`.
        """
        share, more = divmod(len(self.owners), self.shards + 1)
        seen, owners = [0] * self.shards, []
        for shard in self.owners:
            seen[shard] += 1
            owners.append(shard if seen[shard] <= share + (shard < more) else self.shards)
        return SlotMap(self.shards + 1, tuple(owners))

    def moved(self, other: SlotMap) -> list[int]:
        """Slots that another map of as many slots gives to another shard."""
        return [i for i, (a, b) in enumerate(zip(self.owners, other.owners, strict=True)) if a != b]


def rebalanced(old: SlotMap, slot_bytes: Mapping[int, int], tolerance: float = 0.02) -> SlotMap:
    """The map edited until no shard is over the mean by more than ``tolerance``, or no further slot would help.

    In each step the fullest shard hands the largest slot that leaves the gap between both smaller to the emptiest one. Slots
    without bytes stay. A slot of more bytes than a shard's share cannot be split: it stays, and all others leave its shard.
    """
    owners, load = list(old.owners), [0] * old.shards
    own: list[list[tuple[int, int]]] = [[] for _ in range(old.shards)]
    for slot, shard in enumerate(owners):
        size = slot_bytes.get(slot, 0)
        load[shard] += size
        if size:
            own[shard].append((size, slot))
    limit = sum(load) / old.shards * (1 + tolerance)
    settled: set[int] = set()
    while True:
        rest = [s for s in range(old.shards) if s not in settled]
        fullest, emptiest = max(rest, key=lambda s: (load[s], -s), default=None), min(range(old.shards), key=lambda s: (load[s], s))
        if fullest is None or load[fullest] <= limit:
            return SlotMap(old.shards, tuple(owners))
        fits = [x for x in own[fullest] if x[0] < load[fullest] - load[emptiest]]
        if not fits or fullest == emptiest:
            settled.add(fullest)
            continue
        # what brings both nearest to each other; ties by slot number
        best = min(fits, key=lambda x: (abs(load[fullest] - load[emptiest] - 2 * x[0]), x[1]))
        own[fullest].remove(best)
        own[emptiest].append(best)
        owners[best[1]] = emptiest
        load[fullest] -= best[0]
        load[emptiest] += best[0]


class SlotMaps:
    """Versions of a slot map in a folder, behind a pointer to the current one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, VersionedTables(spark, path)

    def version(self) -> int:
        """The current version, 0 before the first."""
        return int(self.store.current() or 0)

    def commit(self, made: SlotMap) -> int:
        """Stores an edited map as the next version. Earlier ones stay readable."""
        version = self.version() + 1
        rows = [(i, shard, made.shards) for i, shard in enumerate(made.owners)]
        frame = self.spark.createDataFrame(rows, "virtual_slot int, shard int, shards int").coalesce(1)
        self.store.publish({"slots": frame}, version=str(version))
        return version

    def load(self, version: int | None = None) -> SlotMap:
        rows = self.store.read("slots", str(version or self.version())).orderBy("virtual_slot").collect()  # MOST_SLOTS at most
        return SlotMap(rows[0].shards, tuple(r.shard for r in rows))


def id_hash(id_col: Column) -> Column:
    """The hash that slots are made of: MD5 of the id as text; a null id counts as the empty text."""
    return F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))


def slot_of(id_col: Column, slots: int = SLOTS) -> Column:
    return (hex_digits(id_hash(id_col), 1, 8) % slots).cast("int")


def record_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def slot_loads(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(virtual_slot, slot_rows, slot_bytes) of the slots that have rows; no more rows than slots."""
    sized = docs.select(slot_of(F.col(id_col), slots).alias("virtual_slot"), record_bytes(F.col(text_col)).alias("_size"))
    return sized.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("slot_rows"), F.sum("_size").alias("slot_bytes"))


def _owners(spark: SparkSession, maps: Sequence[tuple[str, SlotMap]]) -> DataFrame:
    """The maps as one table of slots."""
    rows = [(i, *shards) for i, shards in enumerate(zip(*[m.owners for _, m in maps], strict=True))]
    return spark.createDataFrame(rows, "_slot int, " + ", ".join(f"{name} int" for name, _ in maps))


def shard_documents(
    docs: DataFrame, slot_map: SlotMap, next_map: SlotMap | None = None, id_col: str = "doc_id", text_col: str = "text",
    most: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, virtual_slot, shard, slot, next_shard, slot_rows, slot_bytes.

    ``slot`` is the row's place in its shard, from 0 without gaps: by virtual slot, then by the hash of the id, of rows that
    repeat an id by the hash of the text; rows that repeat both are interchangeable. ``next_shard`` is the shard under
    ``next_map``, null without one. Null ids share a slot; null texts have no bytes and the checksum 0. A hot id has one slot, as
    the law demands, but its rows are placed by many tasks. Other columns are ignored, whatever their names; an empty table
    gives no rows. ``most``: see ``radix_ranks``.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "sharding")
    slots, text = len(slot_map.owners), F.col(text_col)
    plain = docs.select(
        F.col(id_col).alias("_id"), record_bytes(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        id_hash(F.col(id_col)).alias("_hash"), F.xxhash64(text, text.isNull()).alias("_text"), F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_slot", (hex_digits(F.col("_hash"), 1, 8) % slots).cast("int"))
    plain = scratch.write(plain, "records")
    loads = plain.groupBy("_slot").agg(F.count(F.lit(1)).alias("slot_rows"), F.sum("size").alias("slot_bytes"))
    owners = _owners(spark, [("shard", slot_map), *([("next_shard", next_map)] if next_map else [])])
    slots_known = scratch.write(owners.join(loads, "_slot"), "slots")
    placed = plain.join(F.broadcast(slots_known), "_slot")  # a row a slot, MOST_SLOTS at most
    text_hash = F.col("_text").bitwiseXOR(F.lit(-(1 << 63)))
    chunks = [
        [F.col("_slot")],
        [hex_digits(F.col("_hash"), 9, 3), hex_digits(F.col("_hash"), 12, 3)],
        [hex_digits(F.col("_hash"), 15, 4), hex_digits(F.col("_hash"), 19, 4), hex_digits(F.col("_hash"), 23, 4)],
        [F.shiftrightunsigned(text_hash, 48), F.shiftrightunsigned(text_hash, 32).bitwiseAND(F.lit(65_535))],
        row_digits(F.col("_row")),
    ]
    order = ["_slot", F.substring("_hash", 9, 24), "_text", "_row"]
    ranked = radix_ranks(placed, ["shard"], chunks, order, scratch, **({"most": most} if most else {}))
    later = F.col("next_shard") if next_map else F.lit(None).cast("int")
    return ranked.select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.col("_slot").alias("virtual_slot"), "shard", F.col("_rank").alias("slot"),
        later.alias("next_shard"), "slot_rows", "slot_bytes",
    )


def write_shards(
    docs: DataFrame, slot_map: SlotMap, path: str, file_bytes: int = 256 << 20, id_col: str = "doc_id", text_col: str = "text",
    shard_col: str = "shard",
) -> DataFrame:
    """Writes all columns of ``docs`` to a folder a shard below ``path``, in files of about ``file_bytes`` of records.

    The slots of a shard are packed into its files in order by the bytes that were counted; a slot of more bytes than a file is
    dealt to several files row by row. A column named ``shard_col`` is replaced. Returns what was written.
    """
    spark = docs.sparkSession
    slots = len(slot_map.owners)
    loads = {r.virtual_slot: r.slot_bytes for r in slot_loads(docs, slots, id_col, text_col).collect()}  # MOST_SLOTS at most
    used, rows = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.owners):
        size = loads.get(slot, 0)
        rows.append((slot, shard, used[shard] // file_bytes, max(1, -(-size // file_bytes))))
        used[shard] += size
    plan = F.broadcast(spark.createDataFrame(rows, "_slot int, _shard int, _file long, _parts long"))
    kept = [c for c in docs.columns if c != shard_col]
    dealt = docs.withColumn("_slot", slot_of(F.col(id_col), slots)).join(plan, "_slot")
    part = F.pmod(F.monotonically_increasing_id(), F.col("_parts"))
    files = sum(-(-x // file_bytes) for x in used) + slot_map.shards
    dealt = dealt.withColumn("_file", F.col("_file") + part).repartition(max(1, files), "_shard", "_file")
    dealt.select(*kept, F.col("_shard").alias(shard_col)).write.partitionBy(shard_col).mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def shard_sizes(placed: DataFrame) -> DataFrame:
    """(shard, rows, bytes) of what ``shard_documents`` gives."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
