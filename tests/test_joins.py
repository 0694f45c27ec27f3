import pytest
from pyspark.sql import functions as F

from bidtrail.operators import joins

BIG = [("hot", i) for i in range(600)] + [(f"k{i % 90}", i) for i in range(300)] + [(None, i) for i in range(50)]
SMALL = [("hot", "a"), ("hot", "b"), *[(f"k{i}", "c") for i in range(80)], ("absent", "d"), (None, "e")]


@pytest.fixture()
def frames(spark):
    return spark.createDataFrame(BIG, "k string, n int"), spark.createDataFrame(SMALL, "k string, v string")


def test_hot_keys_are_bounded(frames):
    hot = {r["k"]: r["_parts"] for r in joins.hot_keys(frames[0], "k", part_rows=100).collect()}
    assert hot == {"hot": 6}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(frames, rows, how):
    big, small = frames
    assert rows(joins.salted_join(big, small, "k", ["n"], how, part_rows=100)) == rows(big.join(small, "k", how))


def test_salted_semi_join(frames, rows):
    big, small = frames
    assert rows(joins.salted_join(big, small, "k", ["n"], "left_semi", part_rows=100)) == rows(big.join(small, "k", "left_semi"))


def test_hot_key_is_spread(spark, frames):
    big, small = frames
    joined = joins.salted_join(big, small, "k", ["n"], part_rows=100)
    assert joined.where("k = 'hot'").count() == 1200


def test_size_check(frames):
    assert joins.fits_broadcast(frames[1])
    assert not joins.fits_broadcast(frames[1], max_rows=10)
    assert not joins.fits_broadcast(frames[1], max_bytes=100)


def test_keyed_join_falls_back(frames, rows, monkeypatch):
    big, small = frames
    expected = rows(big.join(small, "k", "left"))
    assert rows(joins.keyed_join(big, small, "k", ["n"], "left")) == expected
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    fallback = joins.keyed_join(big, small, "k", ["n"], "left")
    assert rows(fallback) == expected


def test_shares_do_not_matter_but_rows_do(spark):
    """A key of 0.09 % and one of 40 % of a large side are both split by their rows."""
    big = spark.range(100_000).select(F.when(F.col("id") < 90, "small").when(F.col("id") < 40_090, "large").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    parts = {r["k"]: r["_parts"] for r in joins.hot_keys(big, "k", part_rows=50).collect()}
    assert parts == {"small": 2, "large": 800}
    small = spark.createDataFrame([("small", 1), ("large", 2), ("50000", 3)], "k string, v int")
    joined = joins.salted_join(big, small, "k", ["n"], part_rows=50)
    assert {r[0]: r[1] for r in joined.groupBy("k").count().collect()} == {"small": 90, "large": 40_000, "50000": 1}
