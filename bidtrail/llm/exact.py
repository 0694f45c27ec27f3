"""Exact dedup with a split of heavy hitters, in DataFrame and SQL functions alone.

Misra-Gries counters (Spark's frequent-items sketch, COUNTERS of them whatever the data) find digests that may hold a
large share of the rows: a sketch for each task, merged in two levels.  Candidates are counted exactly, and those that
hold HEAVY of all rows or more win; there are at most 1 / HEAVY of them.  The winners are broadcast, so that their
copies are settled where they are read.  All other digests go through an ordinary shuffle, in which by the counters'
guarantee no group holds more than HEAVY of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import tuned

# The sketch's error is 3.5 / 8192 of the rows (6000 counters fill a map of 8192 places), and it names every item whose count
# is over twice that: less than HEAVY.
COUNTERS = 6000
HEAVY = 0.001
# Sketches of so many groups of tasks are merged first, then these.
LANES = 64

RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def normal_text(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _rows(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, the digest of the text, a row number that tells equal rows apart; stored, so that the number stays."""
    digest = F.sha2(normal_text(F.col("text").cast("string")), 256)
    return stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest.alias("text_sha256"), F.monotonically_increasing_id().alias("row"), *carried))


def frequent(rows: DataFrame, column: str, lane: Column, counters: int = COUNTERS) -> DataFrame:
    """item: the values (bigint) of a column that a sketch of `counters` Misra-Gries counters names as frequent."""
    sketches = rows.select(column, lane.alias("lane")).groupBy("lane").agg(F.expr(f"approx_top_k_accumulate({column}, {counters})").alias("sketch"))
    # By a constant group: without any row there is no sketch to merge.
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {counters})")).alias("found")).select(F.col("found.item").alias("item"))


def _first() -> Column:
    """The row that stays: the smallest id (no id comes last), of equal ids the first row."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))


def winners(rows: DataFrame, counters: int = COUNTERS, heavy: float = HEAVY) -> DataFrame:
    """text_sha256, first, group_size of every digest that holds `heavy` of all rows or more; at most 1 / heavy rows."""
    short = rows.withColumn("item", F.xxhash64("text_sha256"))
    # The number of the task that wrote a row stands in the upper bits of its row number.
    candidates = stored(frequent(short, "item", F.pmod(F.shiftright("row", 33), F.lit(LANES)), counters).distinct())
    counted = short.join(F.broadcast(candidates), "item", "left_semi").groupBy("text_sha256").agg(_first().alias("first"), F.count("*").alias("group_size"))
    total = rows.agg((F.count("*") * F.lit(heavy)).alias("least"))
    return stored(counted.where((F.col("group_size") >= total.scalar()) & (F.col("group_size") > 1)))


def _marked(rows: DataFrame, counters: int, heavy: float) -> DataFrame:
    """Every row with `first` (the row that stays) and group_size."""
    won = winners(rows, counters, heavy)
    # At most 1 / heavy rows of some hundred bytes.
    settled = rows.join(F.broadcast(won), "text_sha256")
    others = rows.join(F.broadcast(won.select("text_sha256")), "text_sha256", "left_anti")
    group = Window.partitionBy("text_sha256")
    others = others.withColumns({"first": _first().over(group), "group_size": F.count("*").over(group)})
    return settled.unionByName(others)


def mark_copies(docs: DataFrame, counters: int = COUNTERS, heavy: float = HEAVY) -> DataFrame:
    """Per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after every run of white space has become one space; null counts as empty.  The row
    with the smallest id of a group stays; rows without id come last, so keep_id is null only where no row of the group
    has an id; of repeated rows with that id exactly one stays.  Equality is that of the SHA-256.  An empty table gives
    an empty one; other columns are ignored.
    """
    tuned(docs.sparkSession)
    marked = _marked(_rows(docs), counters, heavy)
    return marked.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")


def remove_copies(docs: DataFrame, counters: int = COUNTERS, heavy: float = HEAVY) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever these are called."""
    tuned(docs.sparkSession)
    marked = _marked(_rows(docs, F.struct(*[docs[c] for c in docs.columns]).alias("doc")), counters, heavy)
    return marked.where(F.col("row") == F.col("first.row")).select("doc.*")
