from bidtrail.operators import parsing
from bidtrail.schemas import BATCH_LAYOUT, RAW_LAYOUT, STREAM_LAYOUT, STREAM_SCHEMA

VALUES = {name: "1" for name in STREAM_LAYOUT} | {"timestamp": "20130606000000000", "ad_slot_floor_price": "5", "user_tags": "10"}


def line(**changes):
    return [(VALUES | changes)[name] for name in STREAM_LAYOUT]


def parse(spark, *lines):
    df = spark.createDataFrame([("\t".join(fields),) for fields in lines], "value string")
    return parsing.parse_lines(parsing.drop_empty(df), STREAM_SCHEMA)


def test_layout_sizes():
    assert (len(RAW_LAYOUT), len(STREAM_LAYOUT), len(BATCH_LAYOUT)) == (24, 23, 24)


def test_good_line(spark):
    row = parse(spark, line()).first()
    assert row["reject_reason"] is None
    assert row["ad_slot_floor_price"] == 5 and row["advertiser_id"] == 1 and row["bidding_price"] == 1.0


def test_empty_line_is_dropped(spark):
    assert parse(spark, [""], line()).count() == 1


def test_field_counts(spark):
    reasons = [r["reject_reason"] for r in parse(spark, line()[:22], line() + ["x", "y"]).collect()]
    assert reasons == ["too few fields", None]


def test_bad_number_is_kept_with_reason(spark):
    parsed = parse(spark, line(ad_slot_width="wide", paying_price="free"), line())
    bad = parsing.rejected(parsed).first()
    assert bad["reject_reason"] == "bad value: ad_slot_width,paying_price"
    assert bad["ad_slot_width"] is None and bad["ad_slot_height"] == 1
    assert parsing.accepted(parsed).count() == 1 and "reject_reason" not in parsing.accepted(parsed).columns


def test_strings(spark):
    df = spark.createDataFrame([("\t".join(line(ad_slot_width="wide")),)], "value string")
    row = parsing.parse_lines_as_strings(df, STREAM_SCHEMA).first()
    assert row["ad_slot_width"] == "wide" and row["reject_reason"] is None


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(7, "\t".join(line()))], "offset long, value string")
    assert parsing.parse_lines(df, STREAM_SCHEMA).first()["offset"] == 7


def test_empty_numbers_are_nulls_not_bad(spark):
    parsed = parse(spark, line(ad_slot_width="", paying_price="", timestamp=""))
    row = parsed.first()
    assert row["reject_reason"] is None and row["ad_slot_width"] is None and row["paying_price"] is None and row["timestamp"] == ""


def test_every_field_is_converted_once(spark):
    parsed = parsing.accepted(parse(spark, line()))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    numbers = [f for f in STREAM_SCHEMA.fields if f.dataType.typeName() not in ("string",)]
    assert plan.lower().count("try_cast(") + plan.lower().count("cast(") <= len(numbers) + 2
