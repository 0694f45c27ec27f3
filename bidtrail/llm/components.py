"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import passing, stored

ROWS_PER_FILE = 200_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's links (u, v) as a link of every node to the smallest one that it reaches over them."""
    root: dict = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for pair in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            ends = []
            for node in pair:
                path = []
                while (up := root.get(node, node)) != node:
                    path.append(node)
                    node = up
                root.update(dict.fromkeys(path, node))
                ends.append(node)
            if ends[0] != ends[1]:
                root[max(ends)] = min(ends)
    if root:
        # A parent is smaller than its children, so in order every parent is settled first.
        for node in sorted(root):
            root[node] = root.get(root[node], root[node])
        yield pa.RecordBatch.from_arrays([pa.array([*x], schema.field(0).type) for x in (root, root.values())], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over edges (a, b), for every node but the smallest of each component.

    Links are contracted within tasks of some ROWS_PER_FILE rows first.  If that takes more than one task, two steps
    alternate until nothing changes: every node's larger neighbours are linked to its smallest neighbour, then its
    smaller ones.  Each round is a minimum per node and a join; rounds grow with the logarithm of the longest path.
    Rounds are written to the shared folder, in as many files as their rows call for.
    """
    with passing(edges.sparkSession):
        return _rooted(edges)


def _rooted(edges: DataFrame) -> DataFrame:
    """What components() returns, of the last table that is stored here."""
    pairs = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    files = 1 + pairs.count() // ROWS_PER_FILE
    pairs = stored(pairs.coalesce(files).mapInArrow(_contracted, pairs.schema))
    if files == 1:
        return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).coalesce(files))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        pairs = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct().coalesce(files))
        size = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size == before:
            return pairs.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        before = size
