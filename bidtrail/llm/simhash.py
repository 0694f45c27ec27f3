"""SimHash fingerprints and near-duplicate classes by meet-in-the-middle ball hashing.

Two fingerprints at RADIUS = 3 or fewer bits differ in at most one bit of their upper or of their lower half.  So every
fingerprint emits, for each half, all variants of that half within one bit (half the radius, rounded down): 33 short
keys.  Two linked fingerprints meet where one emits its own half and the other a variant of it; the keys are shuffled,
duplicates dropped and the colliding pairs verified on all 64 bits.

A key that many different fingerprints share (a family of near copies) would give pairs with the square of its size.
Such keys are linked through pivots first (crowds.py).  Where that leaves several classes in a key, two linked
fingerprints of different classes are not both in its largest one.  They agree in the key's half but for one bit at
most, so flipping one bit of one and up to two bits of the other half of the other one makes them equal: members outside
the largest class emit the variants of one bit and of two bits of the other half, all others those of one bit.  Whatever lies on a
variant is within three bits of every member that is within one bit of it, so linking all of it to the smallest
such member is exact, loses no connection and is linear.  Classes are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import buckets_of, slices, texts, tuned
from .components import components
from .crowds import link_crowds

SHINGLE = 3
RADIUS = 3
SEED = 42
PAIRS_UP_TO = 16
CHUNK_BYTES = 1 << 20
HALF = 0xFFFFFFFF


def shingle_hashes(text: bytes) -> list[int]:
    words = text.lower().split()
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest = xxhash.xxh64_intdigest
    return [digest(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:])]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes: the bits set in more than half of them."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[full]
        sums = np.add.reduceat(ones, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * sums > counts[full, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", CHUNK_BYTES):
        hashes = [np.array(shingle_hashes(t), np.uint64) for t in texts(batch.column("text"))]
        bits = majority_bits(np.concatenate(hashes), np.array([len(h) for h in hashes]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and bits: the 64-bit SimHash of each text's 3-word shingles as a signed long.

    Null text counts as empty; a text without words has zero bits.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id bigint, bits bigint")


def _flips(most: int, width: int) -> list[int]:
    """Masks with up to `most` of `width` bits set, as signed longs."""
    masks = [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _sliced(masks: list[int], most: int = 33) -> list[list[int]]:
    return [masks[i : i + most] for i in range(0, len(masks), most)]


# Masks in slices of about equal length: up to one bit, then two bits of the upper and two of the lower half.
_PAIRS = [m for m in _flips(2, 32) if m.bit_count() == 2]
MASKS = [_sliced(_flips(1, 64)), _sliced([(m << 32) - ((m >> 31) << 64) for m in _PAIRS]), _sliced(_PAIRS)]


def range_of(kind: int) -> list[int]:
    """Numbers of a kind's slices, counted over all kinds."""
    start = sum(map(len, MASKS[:kind]))
    return list(range(start, start + len(MASKS[kind])))


def _half_keys(bits: DataFrame, most: int) -> DataFrame:
    """bits, half (0 low, 1 high), key: the variants of both halves within `most` bits; own marks the half itself."""
    halves = F.explode(F.array(*[F.struct(F.lit(h).alias("half"), F.shiftrightunsigned("bits", 32 * h).bitwiseAND(HALF).alias("value")) for h in (0, 1)]))
    split = bits.select("bits", halves.alias("h")).select("bits", "h.half", "h.value")
    mask = F.explode(F.array(*map(F.lit, _flips(most, 32))).cast("array<bigint>"))
    return split.withColumn("mask", mask).select("bits", "half", F.col("value").bitwiseXOR(F.col("mask")).alias("key"), (F.col("mask") == 0).alias("own"))


def links(bits: DataFrame, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """a, b: links that connect exactly the fingerprints (distinct, column bits) reachable over RADIUS or fewer bits."""
    # A few bytes become many rows here, so rows are dealt out by number, not merged by size.  (By another expression
    # than the one they may be dealt out by already: Spark would drop the step.)
    tasks = buckets_of(bits.sparkSession)
    emitted = _half_keys(bits.repartition(tasks, F.shiftright("bits", 1)), RADIUS // 2)
    sizes = emitted.groupBy("half", "key").agg(F.count("*").alias("n"), F.sum(F.col("own").cast("int")).alias("own_n"))
    shared = stored(sizes.where("own_n >= 1 AND n >= 2"))
    # Spark takes an exploded side to be as small as its source; the variants may not be broadcast.
    members = stored(emitted.join(shared.hint("merge"), ["half", "key"]))

    few = members.where(F.col("n") <= pairs_up_to)
    a = few.where("own").select("half", "key", F.col("bits").alias("a"))
    b = few.select("half", "key", F.col("bits").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = a.join(b, ["half", "key"]).where((F.col("a") != F.col("b")) & close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    crowded = members.where(F.col("n") > pairs_up_to).select(F.struct("half", "key").alias("key"), F.col("bits").alias("node"), "n")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    edges, apart = link_crowds(crowded, stored(pairs.distinct()), lambda some: some.where(near))
    inside = apart.select(F.col("node").alias("bits")).distinct()
    outside = apart.where("root <> largest").select(F.col("node").alias("bits"), F.col("key.half").alias("half")).distinct()
    own = inside.select("bits", F.explode(F.lit(range_of(0))).alias("slice"))
    others = outside.select("bits", F.explode(F.when(F.col("half") == 0, F.lit(range_of(1))).otherwise(F.lit(range_of(2)))).alias("slice"))
    dealt = own.unionByName(others).repartition(tasks, "bits", "slice")
    masks = F.array(*[F.lit(m).cast("array<bigint>") for kind in MASKS for m in kind])
    balls = dealt.withColumn("mask", F.explode(F.get(masks, F.col("slice"))))
    balls = balls.select("bits", F.col("bits").bitwiseXOR(F.col("mask")).alias("variant"), (F.col("slice") < len(MASKS[0])).alias("inner"))
    centres = balls.groupBy("variant").agg(F.min(F.when(F.col("inner"), F.col("bits"))).alias("centre"), F.count("*").alias("n"))
    centres = centres.where("centre IS NOT NULL AND n >= 2").drop("n")
    # Again, neither of these may be broadcast.
    stars = balls.join(centres.hint("merge"), "variant").where("bits <> centre").select(F.least("bits", "centre").alias("a"), F.greatest("bits", "centre").alias("b"))
    return edges.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links of RADIUS or fewer bits).

    One row per row of docs.  Null or empty texts have fingerprint zero and link like others; a null id never names a
    component unless all ids of it are null; equal rows stay separate rows; an empty table gives an empty one; other
    columns are ignored.
    """
    spark = tuned(docs.sparkSession)
    marked = stored(fingerprints(docs))
    classes = marked.groupBy("bits").agg(F.min("doc_id").alias("first"))
    roots = components(links(classes.select("bits"), pairs_up_to))
    grouped = classes.join(roots, F.col("bits") == F.col("node"), "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))
    names = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(grouped.join(names, "root").select("bits", "component_id"))
    return marked.join(named, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
