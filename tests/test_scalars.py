import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidtrail.functions import scalars as fn


def values(spark, ddl, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*columns).collect()]


def test_geo_point(spark):
    got = values(spark, "lat float, lon float", [(1.5, 2.5), (None, 2.5), (1.5, None)], fn.geo_point(F.col("lat"), F.col("lon")))
    assert got == [([2.5, 1.5],), ([0.0, 0.0],), ([0.0, 0.0],)]


def test_ad_slot_size(spark):
    got = values(spark, "w int, h int", [(300, 250), (None, 250), (300, None)], fn.ad_slot_size(F.col("w"), F.col("h")))
    assert got == [("300x250",), ("Unknown",), ("Unknown",)]


def test_user_tags_array(spark):
    texts = [("a,b,,",), (",",), ("",), (None,), (",a",), ("a",)]
    got = values(spark, "s string", texts, fn.user_tags_array(F.col("s")))
    assert got == [(["a", "b"],), ([],), ([""],), (None,), (["", "a"],), (["a"],)]


def test_user_tags_array_delimiter(spark):
    got = values(spark, "s string", [("a|b||",)], fn.user_tags_array(F.col("s"), fn.literal_pattern("|")))
    assert got == [(["a", "b"],)]


def test_event_time_round_trip(spark):
    texts = [("20130606123456789",), ("null",), ("",), (None,), ("20131306123456789",), ("2013060612345678",)]
    got = values(spark, "s string", texts, fn.event_time(F.col("s")), fn.event_time_text(fn.event_time(F.col("s"))))
    assert got[0] == (dt.datetime(2013, 6, 6, 12, 34, 56, 789000), "20130606123456789")
    assert got[1:] == [(None, None)] * 5


def test_event_time_text_pads_fraction(spark):
    times = [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 1, 1, 2, 3, 100000),), (dt.datetime(2024, 1, 1, 1, 2, 3, 456789),)]
    got = values(spark, "t timestamp_ntz", times, fn.event_time_text(F.col("t")))
    assert got == [("20240101000000000",), ("20240101010203100",), ("20240101010203456",)]


def test_file_names(spark):
    name = F.lit("site-click.20130606-aa.txt")
    row = spark.range(1).select(fn.date_in_name(name), fn.index_for_name(name, "log_%s/bid")).first()
    assert tuple(row) == ("20130606", "log_20130606/bid")
    with pytest.raises(Exception, match="no date in file name"):
        spark.range(1).select(fn.date_in_name(F.lit("site-click.txt"))).collect()


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("7", T.IntegerType(), 7),
        ("x", T.IntegerType(), None),
        ("5000000000", T.LongType(), 5_000_000_000),
        ("1.5", T.FloatType(), 1.5),
        ("1.25", T.DoubleType(), 1.25),
        ("TRUE", T.BooleanType(), True),
        ("yes", T.BooleanType(), False),
        ("40000", T.ShortType(), None),
        ("127", T.ByteType(), 127),
        ("ab", T.BinaryType(), bytearray(b"ab")),
        ("2024-01-02 03:04:05.5", T.TimestampNTZType(), dt.datetime(2024, 1, 2, 3, 4, 5, 500000)),
        ("2024-01-02", T.TimestampNTZType(), None),
        ("a,b,", T.ArrayType(T.StringType()), ["a", "b"]),
        ("1,2.5", T.ArrayType(T.FloatType()), [1.0, 2.5]),
        ("1,x", T.ArrayType(T.FloatType()), [1.0, None]),
    ],
)
def test_cast_text(spark, text, kind, expected):
    assert values(spark, "s string", [(text,)], fn.cast_text(F.col("s"), kind)) == [(expected,)]


def test_keyword_fallback_and_key(spark):
    data = [("10", "kw"), ("1,2", None), ("010", None), (None, None)]
    got = values(spark, "tags string, kw string", data, fn.keyword_or_tags(F.col("kw"), F.col("tags")), fn.tag_key(F.col("tags")))
    assert got == [("kw", 10), ("1,2", None), ("010", 10), (None, None)]


def test_prediction_text(spark):
    got = values(spark, "t string, p array<double>", [("cook", [0.25, 0.75])], fn.prediction_text(F.col("t"), F.col("p")))
    assert got == [('"cook" = [0.25, 0.75]',)]
