"""Operators on messages that carry topic, partition and offset columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_read(messages: DataFrame, topic: str, partition: int, start: int | None, limit: int) -> DataFrame:
    """At most `limit` messages of one partition, in offset order from `start` (None: from the first)."""
    chosen = messages.where((F.col("topic") == topic) & (F.col("partition") == partition))
    if start is not None:
        chosen = chosen.where(F.col("offset") >= start)
    return chosen.orderBy("offset").limit(limit)


def offset_ranges(messages: DataFrame) -> DataFrame:
    """First and one-past-last offset of every topic partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def cell_layout(messages: DataFrame, millis: str, family: str, qualifier: str, prefix: str = "") -> DataFrame:
    """Messages as (row_key, col_family, col_qual, value) cells.

    The key starts with the time in milliseconds; partition and offset follow, since a time alone is not unique.
    """
    parts = [F.col(millis), F.col("partition"), F.col("offset")]
    key = F.concat(F.lit(prefix), F.concat_ws("-", *[p.cast("string") for p in parts]))
    return messages.select(
        key.alias("row_key"), F.lit(family).alias("col_family"), F.lit(qualifier).alias("col_qual"), "value"
    )


def ledger_report(ranges: DataFrame) -> DataFrame:
    """topic, partition, kind, from_offset, until_offset: offsets that no range holds, between the first and the last
    one of their partition ('gap'), and offsets that an earlier range holds already ('repeat').

    ranges: topic, partition, from_offset, until_offset (first one beyond), a row per batch and partition, in any order;
    empty ones count for nothing.  Ranges are merged along their start: what lies below the largest end so far is a
    repeat, what lies between that end and the next start a gap.
    """
    kept = ranges.where("from_offset < until_offset")
    before = Window.partitionBy("topic", "partition").orderBy("from_offset", "until_offset").rowsBetween(Window.unboundedPreceding, -1)
    merged = kept.withColumn("reached", F.max("until_offset").over(before)).where("reached IS NOT NULL AND reached <> from_offset")
    gap = F.col("reached") < F.col("from_offset")
    return merged.select(
        "topic", "partition", F.when(gap, "gap").otherwise("repeat").alias("kind"),
        F.least("reached", "from_offset").alias("from_offset"),
        F.when(gap, F.col("from_offset")).otherwise(F.least("reached", "until_offset")).alias("until_offset"),
    )
