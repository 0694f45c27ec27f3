import json

import pytest
from pyspark.sql import functions as F

from bidtrail.operators import messages as msg
from bidtrail.operators import serving, text

DDL = "ipinyou_id string, timestamp string, arrival long, v string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, DDL)


def test_last_row_of_a_key_stays_and_replay_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, ("u", "1", 1, "a"), ("u", "1", 2, "b"), ("u", "2", 3, "c"))
    second = frame(spark, ("u", "1", 1, "d"), ("w", "1", 2, "e"))
    serving.create_table(first, path)
    serving.append_batch(first, path, 0)
    assert [r[3] for r in rows(serving.current_rows(spark, path, ["arrival"]))] == ["b", "c"]
    serving.append_batch(second, path, 1)
    once = rows(serving.current_rows(spark, path, ["arrival"]))
    assert [r[3] for r in once] == ["d", "c", "e"]
    serving.append_batch(second, path, 1)
    assert rows(serving.current_rows(spark, path, ["arrival"])) == once
    assert serving.stored_rows(spark, path, before_batch=1).count() == 3


def test_compact(spark, rows, tmp_path):
    path, folded = str(tmp_path / "t"), str(tmp_path / "folded")
    serving.append_batch(frame(spark, ("u", "1", 1, "a"), ("u", "2", 2, "b")), path, 0)
    serving.append_batch(frame(spark, ("u", "1", 1, "c")), path, 1)
    serving.compact(spark, path, folded, ["arrival"])
    assert rows(serving.current_rows(spark, folded, ["arrival"])) == rows(serving.current_rows(spark, path, ["arrival"]))
    assert spark.read.parquet(folded).count() == 2
    serving.append_batch(frame(spark, ("u", "2", 1, "z")), folded, 0)
    assert [r[3] for r in rows(serving.current_rows(spark, folded, ["arrival"]))] == ["c", "z"]


def test_keyed_dedupe_reduces_before_the_shuffle(spark):
    plan = serving.latest_per_key(frame(spark, ("u", "1", 1, "a")), ["ipinyou_id"], ["arrival"])
    text_plan = plan._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in text_plan and "Partial" in text_plan


def test_delete_and_truncate(spark, rows):
    df = frame(spark, ("u", "1", 1, "a"), ("w", "1", 2, "b"), (None, "1", 3, "c"))
    ids = spark.createDataFrame([("u",), ("u",), (None,)], "ipinyou_id string")
    assert sorted(r["v"] for r in serving.delete_ids(df, ids, "ipinyou_id").collect()) == ["b", "c"]
    assert serving.empty_like(df).count() == 0 and serving.empty_like(df).schema == df.schema


def test_json_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", None, [1.0, 2.0])], "x string, y string, p array<float>")
    assert json.loads(serving.json_documents(df).first()["doc"]) == {"x": "a", "p": [1.0, 2.0]}


def test_serving_schema_fills_probabilities(spark):
    df = spark.createDataFrame([("20130606000000000", None, 0.5)], "timestamp string, false_prob double, true_prob double")
    row = serving.serving_schema(df).first()
    assert (row["false_prob"], row["true_prob"], row["event_time"].year) == (0.0, 0.5, 2013)


def test_daily_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", "20130606"), ("b", "20130607")], "v string, log_date string")
    serving.write_daily(df, str(tmp_path / "d"))
    assert {p.name for p in (tmp_path / "d").glob("log_date=*")} == {"log_date=20130606", "log_date=20130607"}


def test_landing_keys_are_unique(spark):
    landed = serving.landing_rows(spark.range(100).select(F.lit("x").alias("value")))
    assert landed.select("key").distinct().count() == 100


MESSAGES = [("a", "t", 0, 3), ("b", "t", 0, 5), ("c", "t", 0, 4), ("d", "t", 1, 9), ("e", "s", 0, 1)]


def messages(spark):
    return spark.createDataFrame(MESSAGES, "value string, topic string, partition int, offset long")


def test_bounded_read(spark):
    read = lambda start, n: [r["value"] for r in msg.bounded_read(messages(spark), "t", 0, start, n).collect()]
    assert read(None, 2) == ["a", "c"] and read(4, 5) == ["c", "b"] and read(6, 1) == []


def test_offset_ranges(spark, rows):
    assert rows(msg.offset_ranges(messages(spark))) == [("s", 0, 1, 2), ("t", 0, 3, 6), ("t", 1, 9, 10)]


def test_cells_of_one_millisecond_stay_apart(spark):
    cells = msg.cell_layout(messages(spark).where("topic = 't'").withColumn("ms", F.lit(7)), "ms", "cf", "q", "ts")
    assert sorted(r["row_key"] for r in cells.collect()) == ["ts7-0-3", "ts7-0-4", "ts7-0-5", "ts7-1-9"]


def test_word_count(spark, rows):
    lines = spark.createDataFrame([("a b a",), ("b  ",), (" c",), (None,), (" ",)], "value string")
    assert rows(text.word_count(lines)) == [("", 1), ("a", 2), ("b", 2), ("c", 1)]


def test_index_terms(spark):
    df = spark.createDataFrame([(1, "The Red-Shoes of 2013, and more")], "id int, name string")
    assert [r["term"] for r in text.index_terms(df, "name").collect()] == ["red", "shoes", "2013", "more"]


def test_deletes_are_marks_until_compacted(spark, rows, tmp_path):
    path, folded = str(tmp_path / "t"), str(tmp_path / "folded")
    serving.append_batch(frame(spark, ("u", "1", 1, "a"), ("v", "1", 2, "b"), ("w", "1", 3, "c")), path, 0)
    before = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
    live = lambda where: [r[:2] + r[3:] for r in rows(serving.live_rows(spark, where, ["arrival"], "ipinyou_id").select("ipinyou_id", "timestamp", "arrival", "v"))]
    assert len(live(path)) == 3
    ids = spark.createDataFrame([("u",), ("u",), ("w",), (None,), ("nobody",)], "ipinyou_id string")
    for _ in range(2):
        serving.append_deletes(ids, path, 1, "ipinyou_id")
    assert live(path) == [("v", "1", "b")]
    # Only ids were written, and other readers see the table as it was.
    assert [n for n in before if n not in {p.name for p in (tmp_path / "t").rglob("*.parquet")}] == []
    assert serving.stored_rows(spark, path).count() == 3 and serving.batches(spark, path) == [0]
    serving.append_batch(frame(spark, ("u", "1", 9, "again")), path, 2)
    assert live(path) == [("u", "1", "again"), ("v", "1", "b")]
    serving.compact_live(spark, path, folded, ["arrival"], "ipinyou_id")
    assert live(folded) == live(path) and spark.read.parquet(folded).count() == 2


def test_ledger_finds_gaps_and_repeats(spark, rows):
    ranges = [("t", 0, 0, 10), ("t", 0, 2, 4), ("t", 0, 6, 12), ("t", 0, 12, 15), ("t", 0, 20, 21), ("t", 0, 30, 30), ("t", 1, 5, 6), ("u", 0, 1, 3), ("u", 0, 1, 3)]
    df = spark.createDataFrame(ranges, "topic string, partition int, from_offset long, until_offset long")
    want = [("t", 0, "gap", 15, 20), ("t", 0, "repeat", 2, 4), ("t", 0, "repeat", 6, 10), ("u", 0, "repeat", 1, 3)]
    assert rows(msg.ledger_report(df.repartition(3))) == want
    assert msg.ledger_report(df.where("false")).collect() == []


def rows_read(df):
    """Rows that the scans of a frame hand on; row groups that they skip do not count."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    conf = spark._jsc.hadoopConfiguration()
    users = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("ipinyou_id"), F.lit("1").alias("timestamp"), F.col("id").alias("arrival"))
    conf.set("parquet.enable.dictionary", "false")  # as in files with too many users for a dictionary
    try:
        serving.append_batch(users.repartition(16, "ipinyou_id"), path, 0)
    finally:
        conf.unset("parquet.enable.dictionary")
    ten = [r[0] for r in users.select(F.md5(F.concat(F.lit("no"), F.col("arrival").cast("string")))).limit(10).collect()]
    absent = serving.rows_of_users(spark, path, ten)
    assert rows_read(absent) < 1000 and absent.count() == 0
    one = users.first()["ipinyou_id"]
    assert 0 < rows_read(serving.rows_of_users(spark, path, [one, None, one])) < 1000
    assert [r["arrival"] for r in serving.rows_of_users(spark, path, [one, None, one]).collect()] == [0]
    conf.set("parquet.filter.bloom.enabled", "false")
    try:
        assert rows_read(serving.rows_of_users(spark, path, ten)) == 4000
    finally:
        conf.unset("parquet.filter.bloom.enabled")


def test_long_lookups_and_bucket_counts(spark, rows, tmp_path):
    path, folded = str(tmp_path / "t"), str(tmp_path / "folded")
    df = spark.range(100).select(F.concat(F.lit("u"), F.col("id") % 40).alias("ipinyou_id"), F.col("id").cast("string").alias("timestamp"), F.col("id").alias("arrival"))
    serving.set_buckets(spark, path, 128)
    serving.append_batch(df, path, 0, by_user=True)
    wanted = [f"u{i}" for i in range(25)] + ["u3", "nobody"]
    expected = rows(df.where(F.col("ipinyou_id").isin(wanted)))
    assert rows(serving.current_rows_of_users(spark, path, wanted, ["arrival"]).select(df.columns)) == expected
    assert serving.rows_of_users(spark, path, [None]).collect() == []
    assert serving.table_buckets(spark, path) == 128
    with pytest.raises(ValueError):
        serving.set_buckets(spark, path, 64)
    for _ in range(2):  # a compaction may be repeated
        serving.compact(spark, path, folded, ["arrival"], by_user=True)
        assert rows(serving.current_rows_of_users(spark, folded, wanted, ["arrival"]).select(df.columns)) == expected
    assert serving.table_buckets(spark, folded) == 128 and serving.stored_bytes(spark, str(tmp_path / "none")) == 0
    assert [serving.bucket_count(n) for n in (0, 64 * serving.BUCKET_BYTES, 64 * serving.BUCKET_BYTES + 1, 1 << 60)] == [64, 64, 128, serving.MOST_BUCKETS]
