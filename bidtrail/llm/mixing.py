"""Mixing of sources to target weights by a low-discrepancy schedule.

The mix is a schedule of slots.  Slot i has the golden-ratio point frac((i + 1/2) * phi); the point falls into the
part of [0, 1) that a source's target takes, so any stretch of the schedule holds the sources in nearly their shares.
The r-th slot of a source takes its block r, counted round and round: a block is BLOCK_WORDS consecutive words of the
source's documents in shuffled order (the last one may be shorter).  A block is never taken more than `most` times.

No step gathers a source: slots are ranked in two levels (counts per stretch of the schedule, then inside a stretch),
and documents are laid end to end the same way (sums per range of the shuffling hash, then inside a range).  Sources may
be as many as documents: they, too, are ranked and summed in two levels, and met with points in as many cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import buckets_of, slices, tuned, utf8, word_starts

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
CELLS = 4096  # at least; as many as sources where these are more
UNITS = 1 << 20  # of a slot, so that shares are added as whole numbers
STRETCH = 1 << 16
PHI = 0.6180339887498949
PHI_STRETCH = 0.47548671310871195  # frac(STRETCH * phi), to more digits than the product would keep
CHUNK_BYTES = 1 << 20


def with_sizes(docs: DataFrame) -> DataFrame:
    """All columns and size: the number of words of the text, null: 0."""
    schema = T.StructType([*docs.schema.fields, T.StructField("size", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(word_starts(*utf8(batch.column("text")))[1])], names=[*batch.schema.names, "size"])

    return docs.mapInArrow(count, schema)


def running_sums(rows: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """rows, and for each of `columns` upto_<column>: its sum over all rows up to this one in the given order.

    Ranges of the order are summed first; a running sum inside each range starts from the sum of those before it.
    """
    # The range of a row is stored with it, so that it stays the same in both passes.
    dealt = stored(rows.repartitionByRange(buckets_of(rows.sparkSession), *order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    totals = dealt.groupBy("range").agg(*[F.sum(c).alias(c) for c in columns])
    offsets = totals.select("range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in columns])
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumns({f"upto_{c}": F.sum(c).over(inside) for c in columns}).join(F.broadcast(offsets), "range")
    return summed.select(*rows.columns, *[(F.col(f"upto_{c}") + F.col(f"before_{c}")).alias(f"upto_{c}") for c in columns])


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, place, target of each source of (source, source_size), one row per source.

    Sources by code point, null last, weigh `weights` in turn and share the sum of all sizes.  A target stops at `most`
    times its source's size and the excess goes to the others by weight: target = min(cap, level * weight), where
    the level follows from the sources in order of cap over weight.
    """
    rows = running_sums(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], ["one"])
    rows = rows.select("source", "source_size", "one", (F.col("upto_one") - 1).alias("place"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    rows = rows.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    rows = stored(running_sums(rows, [F.col("ratio"), F.col("place")], ["cap", "weight", "one"]))
    total, weighed = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    capped, left = F.col("upto_cap") - F.col("cap"), F.lit(weighed) - F.col("upto_weight") + F.col("weight")
    level = (F.lit(total) - capped) / left
    final = rows.where(level * F.col("weight") <= F.col("cap")).agg(F.min(F.struct("upto_one", level.alias("level")))).first()[0]
    target = F.least("cap", F.lit(final["level"]) * F.col("weight")) if final else F.col("cap")
    return rows.select("source", "source_size", "place", target.alias("target"))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS, most: int = MOST) -> DataFrame:
    """slot, place, block, copy: which block of which source each slot takes.

    sources: place, source_size, target.  A source's share of the slots is the number of blocks its target stands for.
    """
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    shares = sources.where("source_size > 0 AND target > 0").withColumn("blocks", blocks)
    share = F.col("target") / F.col("source_size") * F.col("blocks")
    shares = stored(running_sums(shares.withColumn("units", F.round(share * UNITS).cast("bigint")), [F.col("place")], ["units"]))
    total, n_sources = shares.agg(F.coalesce(F.sum("units"), F.lit(0)), F.count("*")).first()
    n, cells = (total + UNITS // 2) // UNITS, max(CELLS, n_sources)
    last = F.col("upto_units") == total
    shares = shares.select(
        "place",
        "blocks",
        ((F.col("upto_units") - F.col("units")) / F.lit(float(total))).alias("low"),
        F.when(last, 2.0).otherwise(F.col("upto_units") / F.lit(float(total))).alias("high"),
    )
    within = F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))
    pieces = shares.where("low < high").withColumn("cell", F.explode(within))

    stretch = F.expr(f"id div {STRETCH}")
    point = stretch * PHI_STRETCH + (F.pmod("id", F.lit(STRETCH)) + 0.5) * PHI
    slots = spark.range(n).select(F.col("id").alias("slot"), stretch.alias("stretch"), (point - F.floor(point)).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells))
    mapped = slots.join(pieces, "cell").where("point >= low AND point < high").select("slot", "stretch", "place", "blocks")
    mapped = stored(mapped)
    counts = mapped.groupBy("place", "stretch").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("place").orderBy("stretch")) - F.col("n")
    counts = counts.select("place", "stretch", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("place", "stretch").orderBy("slot")) - 1
    ranked = mapped.withColumn("inside", inside).join(counts, ["place", "stretch"]).withColumn("turn", F.col("before") + F.col("inside"))
    return ranked.where(F.col("turn") < most * F.col("blocks")).select(
        "slot", "place", F.expr("turn % blocks").alias("block"), F.expr("turn div blocks").alias("copy")
    )


def mix(docs: DataFrame, carry: list[str] = (), seed: int = 0, weights: tuple = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, and the columns in `carry`; one row per row of docs.

    taken: words the mix takes of the document, repeats counted: whole copies of it, and the first taken % size words
    once more.  Null and empty texts have size 0 and nothing taken; a source without words has target 0.  The order of
    documents inside a source is a hash of doc_id and seed, so reruns agree; repeated rows are mixed one by one and
    are alike but for their place.  A null source is a source of its own.  An empty table gives an empty one.
    """
    spark = tuned(docs.sparkSession)
    rest = F.struct(F.lit(0).alias("_"), *carry).alias("rest")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), rest)
    sized = stored(with_sizes(rows).drop("text").withColumn("row", F.monotonically_increasing_id()))
    thin = sized.drop("rest")
    sources = stored(targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    times = schedule(sources, block_words, most).groupBy("place", "block").agg(F.count("*").alias("times"))

    named = thin.where("size > 0").join(sources.select(F.col("source").alias("s"), "place"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    order = F.xxhash64(F.lit(seed), "doc_id")
    named = named.withColumn("order", order).withColumn("range", F.shiftright("order", 54))
    sums = named.groupBy("place", "range").agg(F.sum("size").alias("n"))
    base = F.sum("n").over(Window.partitionBy("place").orderBy("range")) - F.col("n")
    sums = sums.select("place", "range", base.alias("base"))
    inside = F.sum("size").over(Window.partitionBy("place", "range").orderBy("order", "doc_id", "row")) - F.col("size")
    placed = named.withColumn("inside", inside).join(sums, ["place", "range"]).withColumn("at", F.col("base") + F.col("inside"))
    end = F.col("at") + F.col("size")
    pieces = placed.select("row", "place", "at", end.alias("end"), F.explode(F.sequence(F.expr(f"at div {block_words}"), F.expr(f"(at + size - 1) div {block_words}"))).alias("block"))
    words = F.least("end", (F.col("block") + 1) * block_words) - F.greatest("at", F.col("block") * block_words)
    used = pieces.withColumn("words", words).join(times, ["place", "block"])
    taken = used.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))

    whole = sized.join(taken, "row", "left").join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    columns = ["doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")]
    return whole.select(*columns, *[F.col("rest")[c].alias(c) for c in carry if c not in ("doc_id", "source", "size")])


def word_prefix(text: str, words: int) -> str:
    """The text up to the end of its words-th word."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    starts, _ = word_starts(raw, np.array([len(raw)]))
    if words >= len(starts):
        return text
    return data[: starts[words]].rstrip(b" \t\n\v\f\r").decode()


def take(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: `columns` of each document as often as it is taken, the last time cut to the words that are left.

    mixed: what mix() returns with `columns` carried.  n_chars, where it is among them, follows the cut text.
    """
    copies = F.sequence(F.lit(0), F.expr("(taken - 1) div size"))
    turns = mixed.where("taken > 0").withColumn("turn", F.explode(copies)).withColumn("words", F.least("size", F.expr("taken - turn * size")))
    rows = turns.select(*columns, "words", "size")
    schema = rows.drop("words", "size").schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            lists = {c: batch.column(c) for c in columns}
            words, sizes = batch.column("words").to_pylist(), batch.column("size").to_pylist()
            text = [t if w >= n else word_prefix(t, w) for t, w, n in zip(lists["text"].to_pylist(), words, sizes)]
            lists["text"] = pa.array(text, pa.string())
            if "n_chars" in lists:
                lists["n_chars"] = pa.array([len(t) for t in text], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(lists.values()), names=list(lists))

    return rows.mapInArrow(cut, schema)
