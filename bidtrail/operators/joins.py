"""Joins that stay whole and balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

Hold = Callable[[DataFrame], DataFrame]

# A side is sent to every executor only below both bounds (measured, not estimated).
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that one task is meant to join; a key with more is split into as many parts as that takes.
PART_ROWS = 5_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a frame in one distributed pass: rows, and bytes of text plus the width of the other columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 * len(df.columns)))
    row = df.agg(F.count("*").alias("n"), F.sum(length).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def hot_keys(df: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Keys with more than part_rows rows, each with the number of parts to split it into."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_rows") > part_rows).select(key, F.ceil(F.col("_rows") / part_rows).cast("int").alias("_parts"))


def salted_join(
    big: DataFrame, small: DataFrame, key: str, spread: list[str], how: str = "inner", part_rows: int = PART_ROWS, hold: Hold = stored
) -> DataFrame:
    """Equi join that splits the hot keys of `big` over many tasks.

    Rows of a hot key are spread by a hash of the `spread` columns (a stable choice, so a recomputed task
    sends each row to the same place) and the matching rows of `small` are repeated once per part.  All
    other keys are joined as usual.  The table of hot keys is held; it is broadcast only if it measures small.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    hot = hold(hot_keys(big, key, part_rows))
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    # Null keys match nothing, so they can be spread freely.
    ways = F.when(F.col(key).isNull(), F.lit(int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")))).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.pmod(F.xxhash64(*spread), ways).cast("int")
    spread_big = big.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))
    repeated = small.join(hot, key, "left").withColumn("_part", F.explode(parts)).drop("_parts")
    return spread_big.join(repeated, [key, "_part"], how).drop("_part")


def keyed_join(
    big: DataFrame, small: DataFrame, key: str, spread: list[str], how: str = "inner", hold: Hold = stored
) -> DataFrame:
    """Join a large frame to one that is usually small: broadcast it if it measures small, else split hot keys.

    `hold` keeps the small side (by default as a table in the shared folder), so that measuring and joining it
    compute it once.
    """
    held = hold(small)
    if fits_broadcast(held):
        return big.join(F.broadcast(held), key, how)
    return salted_join(big, held, key, spread, how, PART_ROWS, hold)
