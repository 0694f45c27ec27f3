"""Sharding over fixed virtual slots.  DataFrame functions only.

Records are hashed into SLOTS virtual slots.  The bytes of every slot are summed (a few thousand numbers, whatever the
data size), and a small versioned map says which shard holds which slot.  Rebalancing edits that map: slots move from
the fullest shard to the emptiest, or are swapped between them, until the sizes are as near as slots allow.

A slot can be over-full only where many rows have one id, or none and one text.  The rows of such slots get a number
each, stored with them, and are dealt out again over all slots by that number; the map says which slots were split.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, stored
from .common import tuned

SLOTS = 4096
SHARDS = 16
SPLIT_ROWS = 1_000  # a slot is split where it holds more rows than this
SPLIT_TIMES = 8  # and more than this many times the mean of all slots


@dataclass(frozen=True)
class SlotMap:
    """Shard of every virtual slot, in a version; sizes of the slots it was made for, and slots whose rows went elsewhere."""

    version: int
    shards: int
    shard: tuple[int, ...]
    size: tuple[int, ...]
    rows: tuple[int, ...]
    split: tuple[int, ...] = ()

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard):
            out[shard] += self.size[slot]
        return out


def even_map(size: list[int], rows: list[int], shards: int, split: tuple[int, ...] = ()) -> SlotMap:
    """Version 1: slots dealt out in turn."""
    return SlotMap(1, shards, tuple(s % shards for s in range(len(size))), tuple(size), tuple(rows), split)


def rebalanced(old: SlotMap, shards: int | None = None) -> SlotMap:
    """The next version: single slots moved or swapped from the fullest to the emptiest shard while that evens them out.

    Moving or swapping a difference x changes the gap g between the two to |g - 2x|, so the x nearest to g / 2 is
    sought among the slots of both.  The work is bounded by the number of slots, not by the data.
    """
    shards = shards or old.shards
    held = [[] for _ in range(shards)]
    for slot, shard in enumerate(old.shard):
        held[shard].append((old.size[slot], slot))
    for slots in held:
        slots.sort()
    loads = [sum(size for size, _ in slots) for slots in held]
    for _ in range(4 * len(old.shard)):
        order = sorted(range(shards), key=lambda s: (loads[s], s))
        full, done = order[-1], True
        for spare in order[:-1]:
            gap = loads[full] - loads[spare]
            best = (gap, None, None)
            for give in held[full]:
                for take in _nearest(held[spare], give[0] - gap / 2):
                    left = abs(gap - 2 * (give[0] - (take[0] if take else 0)))
                    if left < best[0]:
                        best = (left, give, take)
            if best[1] is not None:
                _, give, take = best
                held[full].remove(give)
                held[spare].append(give)
                if take:
                    held[spare].remove(take)
                    held[full].append(take)
                held[full].sort()
                held[spare].sort()
                moved = give[0] - (take[0] if take else 0)
                loads[full] -= moved
                loads[spare] += moved
                done = False
                break
        if done:
            break
    shard = [0] * len(old.shard)
    for number, slots in enumerate(held):
        for _, slot in slots:
            shard[slot] = number
    return replace(old, version=old.version + 1, shards=shards, shard=tuple(shard))


def _nearest(slots: list[tuple[int, int]], size: float) -> list:
    """Nothing, and the slots next to a size from below and above."""
    at = bisect_left(slots, (size, -1))
    return [None, *slots[max(0, at - 1) : at + 1]]


def store_map(spark: SparkSession, versions: list[SlotMap], path: str | None = None) -> str:
    """Append versions to the stored map: version, virtual_slot, shard, bytes, rows, split.  Returns the folder."""
    path = path or scratch_path(spark, "slot-map")
    for v in versions:
        slot = F.col("id").cast("int")
        spark.range(len(v.shard), numPartitions=1).select(
            F.lit(v.version).alias("version"),
            slot.alias("virtual_slot"),
            _of(v.shard, slot + 1, "int").alias("shard"),
            _of(v.size, slot + 1, "bigint").alias("bytes"),
            _of(v.rows, slot + 1, "bigint").alias("rows"),
            slot.isin(*v.split).alias("split"),
        ).write.mode("append").parquet(path)
    return path


def read_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version of the map, the latest by default."""
    rows = spark.read.parquet(path)
    version = version or rows.agg(F.max("version")).first()[0]
    found = rows.where(F.col("version") == version).orderBy("virtual_slot").collect()
    shard = tuple(r["shard"] for r in found)
    return SlotMap(version, max(shard) + 1, shard, tuple(r["bytes"] for r in found), tuple(r["rows"] for r in found), tuple(r["virtual_slot"] for r in found if r["split"]))


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus one), text_crc32, virtual_slot (by doc_id; without one, by text)."""
    doc_id, text = F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(doc_id, F.when(doc_id.isNull(), text))
    return docs.select(
        doc_id,
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every virtual slot; at most one row per slot comes to the driver."""
    size, count = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect():
        size[r[0]], count[r[0]] = r[1], r[2]
    return size, count


def overfull(rows: list[int]) -> tuple[int, ...]:
    """Slots with so many rows that they are to be split, from the rows of every slot."""
    return tuple(s for s, n in enumerate(rows) if n > SPLIT_ROWS and n * len(rows) > SPLIT_TIMES * sum(rows))


def dealt_again(rows: DataFrame, split: tuple[int, ...], slots: int = SLOTS) -> DataFrame:
    """The rows stored, those of split slots under the slot of a number of their own."""
    salt = F.xxhash64(F.lit("split"), F.monotonically_increasing_id())
    slot = F.when(F.col("virtual_slot").isin(*split), F.pmod(salt, F.lit(slots)).cast("int")).otherwise(F.col("virtual_slot"))
    return stored(rows.withColumn("virtual_slot", slot))


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version under the law `bytes`.

    slot numbers the rows of a shard without gaps from 0: by virtual slot, inside it by doc_id.  Null and empty texts
    have size 1.  Rows without a doc_id are dealt out by their text.  Repeated rows are numbered one by one, in any
    order between equals; where they make a slot over-full, they are dealt out one by one.  An empty table gives an
    empty one; other columns are ignored.
    """
    spark = tuned(docs.sparkSession)
    rows = sized(docs, slots)
    size, count = slot_sizes(rows, slots)
    split = overfull(count)
    if split:
        rows = dealt_again(rows, split, slots)
        size, count = slot_sizes(rows, slots)
    first = even_map(size, count, shards, split)
    chosen = rebalanced(first)
    store_map(spark, [first, chosen], map_path)
    before, starts = [0] * shards, []
    for slot in range(slots):
        starts.append(before[chosen.shard[slot]])
        before[chosen.shard[slot]] += chosen.rows[slot]
    at = F.col("virtual_slot") + 1
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        _of(chosen.shard, at, "int").alias("shard"),
        (_of(starts, at, "bigint") + inside - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(chosen.version).alias("map_version"),
    )


def _of(values: list | tuple, at: Column, kind: str) -> Column:
    """Look-up in a constant array; as one text it is a single expression that Spark folds."""
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>"), at)
