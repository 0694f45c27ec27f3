import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidtrail.operators import serving, text
from bidtrail.operators.history import HISTORY_DDL, with_no_features
from bidtrail.plans import logview as view
from bidtrail.plans import scoring
from bidtrail.plans.enrichment import enrich_log
from bidtrail.plans.queries import lead_rows
from bidtrail.operators.parsing import accepted, drop_empty, parse_lines, rejected
from bidtrail.schemas import FEATURE_COLUMNS, MESSAGE_SCHEMA, PREDICTION_COLUMNS, STREAM_SCHEMA
from bidtrail.sources.messages import file_stream
from bidtrail.streaming import jobs, state

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def known(spark):
    return view.dictionaries(spark, SF)


@pytest.fixture(scope="module")
def messages(spark):
    return view.log_messages(spark, SF, view.table(spark, SF, "events")).cache()


@pytest.fixture()
def source(spark, messages, tmp_path):
    """All messages as one file of a stream."""
    path = str(tmp_path / "source")
    messages.coalesce(1).write.parquet(path)
    return file_stream(spark, path, MESSAGE_SCHEMA)


def test_enriched_stream_equals_batch(spark, source, messages, known, rows, tmp_path):
    out = str(tmp_path / "out")
    jobs.enrich_stream(source, known, out, str(tmp_path / "rejects"), str(tmp_path / "cp"), once=True).awaitTermination()
    batch = enrich_log(accepted(parse_lines(drop_empty(messages.select("value")), STREAM_SCHEMA)), known, slot_size=True)
    assert rows(spark.read.parquet(out).drop("batch_id")) == rows(batch)
    assert spark.read.parquet(str(tmp_path / "rejects")).isEmpty()


def test_accepted_and_rejected_are_all_that_was_read(spark, messages, tmp_path):
    parsed = jobs.parsed_rows(view.damaged_messages(messages))
    assert accepted(parsed).count() + rejected(parsed).count() == messages.count() == 1000
    path, out = str(tmp_path / "damaged"), str(tmp_path / "out")
    view.damaged_messages(messages).write.parquet(path)
    stream = file_stream(spark, path, MESSAGE_SCHEMA)
    jobs.parse_stream(stream, STREAM_SCHEMA, lambda log: log.select("bid_id"), out, f"{out}-rejects", str(tmp_path / "cp"), once=True).awaitTermination()
    good, bad = spark.read.parquet(out), spark.read.parquet(f"{out}-rejects")
    assert good.count() + bad.count() == 1000
    assert {r[0] for r in bad.select("reject_reason").distinct().collect()} == {"too few fields", "bad value: ad_slot_width"}


def test_keyword_documents_skip_an_empty_batch(spark, messages, known, tmp_path):
    path, out = str(tmp_path / "bad"), str(tmp_path / "docs")
    messages.limit(3).withColumn("value", F.lit("no line")).write.parquet(path)
    jobs.keyword_documents(file_stream(spark, path, MESSAGE_SCHEMA), known, out, str(tmp_path / "rejects"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert not (tmp_path / "docs").exists() and spark.read.parquet(str(tmp_path / "rejects")).count() == 3


def test_restart_adds_only_new_rows(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):
        jobs.land_raw(source, out, checkpoint, once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 1000


def test_word_counts_add_up(spark, messages, rows, tmp_path):
    path = str(tmp_path / "many")
    messages.repartition(4).write.parquet(path)
    stream = file_stream(spark, path, MESSAGE_SCHEMA, max_files=1)
    out = str(tmp_path / "out")
    jobs.count_words(stream, out, str(tmp_path / "cp"), once=True).awaitTermination()
    counted = spark.read.parquet(out)
    assert counted.select("batch_id").distinct().count() == 4
    assert rows(counted.groupBy("word").agg(F.sum("n"))) == rows(text.word_count(messages))


@pytest.fixture(scope="module")
def model(spark):
    return scoring.train_lead_model(lead_rows(spark, SF))


def scored_table(spark, messages, known, model, tmp_path, name, files, repeat=1):
    """Score the messages cut into files by offset; each file is one batch."""
    root = tmp_path / name
    parsed = jobs.served_rows(jobs.parsed_rows(messages), known)
    table = str(root / "table")
    serving.create_table(scoring.score_leads(model, with_no_features(parsed)), table, by_user=True)
    edge = [i * 1000 // files for i in range(files + 1)]
    for low, high in zip(edge, edge[1:]):
        part = messages.where((F.col("offset") >= low) & (F.col("offset") < high))
        part.coalesce(1).write.mode("append").parquet(str(root / "source"))
        for run in range(repeat):
            stream = file_stream(spark, str(root / "source"), MESSAGE_SCHEMA)
            checkpoint = str(root / "cp")
            jobs.score_stream(spark, stream, known, model, table, str(root / "docs"), str(root / "rejects"), checkpoint, once=True).awaitTermination()
    return table


def test_batches_see_what_came_before(spark, messages, known, model, rows, tmp_path):
    table = scored_table(spark, messages, known, model, tmp_path, "a", files=2)
    stored = spark.read.parquet(table).cache()
    first, second = stored.where("batch_id = 0"), stored.where("batch_id = 1")
    assert first.where(" OR ".join(f"{f} IS NOT NULL" for f in FEATURE_COLUMNS)).isEmpty()
    # A user of the second batch has features exactly if the first batch holds the user.
    users = {r[0] for r in first.select("ipinyou_id").distinct().collect()}
    featured = second.groupBy("ipinyou_id").agg(F.max(F.col("bid_click_kw").isNotNull()).alias("known")).collect()
    assert {r["ipinyou_id"] for r in featured if r["known"]} == {r["ipinyou_id"] for r in featured} & users
    assert stored.where("abs(false_prob + true_prob - 1) > 1e-9 OR predict NOT IN ('TRUE', 'FALSE')").isEmpty()
    assert spark.read.text(str(tmp_path / "a" / "docs")).count() == stored.count()


def test_another_checkpoint_does_not_replace_batches(spark, messages, known, model, rows, tmp_path):
    table = scored_table(spark, messages, known, model, tmp_path, "b", files=1)
    kept = ["bid_id", *FEATURE_COLUMNS, *PREDICTION_COLUMNS]
    once = rows(spark.read.parquet(table).select(kept))

    def again(**options):
        stream = file_stream(spark, str(tmp_path / "b" / "source"), MESSAGE_SCHEMA)
        return jobs.score_stream(spark, stream, known, model, table, str(tmp_path / "docs"), str(tmp_path / "r"), str(tmp_path / "cp2"), once=True, **options)

    with pytest.raises(ValueError, match="first_batch=1"):
        again()
    assert rows(spark.read.parquet(table).select(kept)) == once
    again(first_batch=1).awaitTermination()
    assert rows(spark.read.parquet(table).where("batch_id = 0").select(kept)) == once
    assert serving.batches(spark, table) == [serving.BASE, 0, 1]


def test_repeated_batch_changes_nothing(spark, messages, known, model, rows, tmp_path):
    """The commit of a batch gets lost; the restarted query runs it again."""
    table = scored_table(spark, messages, known, model, tmp_path, "c", files=1)
    kept = ["bid_id", *FEATURE_COLUMNS, *PREDICTION_COLUMNS]
    once = rows(spark.read.parquet(table).select(kept))
    lost = [p for p in (tmp_path / "c" / "cp" / "commits").iterdir()]
    assert lost
    for p in lost:
        p.unlink()
    stream = file_stream(spark, str(tmp_path / "c" / "source"), MESSAGE_SCHEMA)
    jobs.score_stream(spark, stream, known, model, table, str(tmp_path / "c" / "docs"), str(tmp_path / "c" / "rejects"), str(tmp_path / "c" / "cp"), once=True).awaitTermination()
    assert rows(spark.read.parquet(table).select(kept)) == once


def test_order_of_messages_does_not_matter(spark, messages, known, model, rows, tmp_path):
    """Both keyword rows of a message stay, whatever the order of the input."""
    tables = [
        scored_table(spark, part, known, model, tmp_path, name, files=3)
        for name, part in (("d", messages), ("e", messages.orderBy(F.xxhash64("offset"))))
    ]
    kept = ["bid_id", "keyword_name", *FEATURE_COLUMNS, *PREDICTION_COLUMNS]
    first, second = (rows(serving.current_rows(spark, t, ["partition", "offset"]).select(kept)) for t in tables)
    assert first == second and spark.read.parquet(tables[0]).where("batch_id >= 0").select("batch_id").distinct().count() == 3


def test_a_batch_of_few_users_reads_few_buckets(spark, messages, known, model, tmp_path):
    table = scored_table(spark, messages, known, model, tmp_path, "f", files=1)
    schema = T.StructType([f for f in spark.read.parquet(table).schema.fields if f.name not in (serving.BATCH, serving.BUCKET)])
    user = spark.read.parquet(table).first()["ipinyou_id"]
    bucket = spark.createDataFrame([(user,)], "ipinyou_id string").select(serving.user_bucket()).first()[0]
    few = serving.stored_rows(spark, table, schema=schema, buckets=[bucket])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "user_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    everything = serving.stored_rows(spark, table, schema=schema)
    assert 0 < few.count() < everything.count()
    assert few.where(F.col("ipinyou_id") == user).count() == everything.where(F.col("ipinyou_id") == user).count() > 0
    folded = str(tmp_path / "folded")
    serving.compact(spark, table, folded, ["partition", "offset"], by_user=True)
    assert serving.stored_rows(spark, folded, schema=schema, buckets=[bucket]).where(F.col("ipinyou_id") == user).count() > 0


def scored_with_state(spark, messages, known, model, root, edges, history=None):
    """Score the messages cut at some offsets, each part by a new run of the query; the table and the last run's query."""
    table = str(root / "table")
    serving.create_table(scoring.score_leads(model, with_no_features(jobs.served_rows(jobs.parsed_rows(messages), known))), table, by_user=True)
    query = None
    for low, high in zip(edges, edges[1:]):
        messages.where((F.col("offset") >= low) & (F.col("offset") < high)).coalesce(1).write.mode("append").parquet(str(root / "source"))
        past = file_stream(spark, history, T.StructType.fromDDL(HISTORY_DDL)) if history else None
        stream = file_stream(spark, str(root / "source"), MESSAGE_SCHEMA)
        query = jobs.score_stream_with_state(spark, stream, past, known, model, table, str(root / "docs"), str(root / "rejects"), str(root / "cp"), once=True)
        query.awaitTermination()
    return table, query


def test_state_gives_the_features_of_the_table(spark, messages, known, model, rows, tmp_path):
    """Three runs, each a restart from the checkpoint, equal the job that reads its table."""
    kept = ["bid_id", "keyword_name", *FEATURE_COLUMNS, *PREDICTION_COLUMNS]
    read = scored_table(spark, messages, known, model, tmp_path, "read", files=3)
    held, _ = scored_with_state(spark, messages, known, model, tmp_path / "held", [0, 333, 666, 1000])
    first, second = (rows(spark.read.parquet(t).where("batch_id >= 0").select("batch_id", *kept)) for t in (read, held))
    assert first == second and len(first) > 800


def test_state_needs_no_row_of_the_past(spark, messages, known, model, rows, tmp_path):
    """History comes with the first batch alone, and later batches work without its files and without the table."""
    older = jobs.served_rows(jobs.parsed_rows(messages.where("offset < 500")), known)
    past, root = str(tmp_path / "past"), tmp_path / "job"
    serving.history_snapshot(older, past)
    recent = messages.where("offset >= 500")
    table, _ = scored_with_state(spark, recent, known, model, root, [500, 700], history=past)
    for part in (root / "table").glob("batch_id=0/*"):
        part.rename(tmp_path / part.name)
    recent.where("offset >= 700").coalesce(1).write.mode("append").parquet(str(root / "source"))
    stream, history = file_stream(spark, str(root / "source"), MESSAGE_SCHEMA), file_stream(spark, past, T.StructType.fromDDL(HISTORY_DDL))
    query = jobs.score_stream_with_state(spark, stream, history, known, model, table, str(root / "docs"), str(root / "rejects"), str(root / "cp"), once=True)
    query.awaitTermination()
    progress = query.recentProgress[-1]
    read = {s["description"].rsplit("/", 1)[-1].rstrip("]"): s["numInputRows"] for s in progress["sources"]}
    assert read["past"] == 0 and read["source"] > 0
    assert progress["stateOperators"][0]["numRowsTotal"] >= older.select("ipinyou_id").distinct().count()
    plan = query._jsq.explainInternal(False)
    assert "FlatMapGroupsInPandasWithState" in plan and "/table" not in plan and "/past" not in plan
    want = scored_table(spark, messages, known, model, tmp_path, "all", files=1)
    late = spark.read.parquet(f"{table}/batch_id=1").select("bid_id", *FEATURE_COLUMNS)
    cutoffs = late.where("site_open_kw IS NOT NULL")
    assert late.count() == jobs.served_rows(jobs.parsed_rows(messages.where("offset >= 700")), known).count() and cutoffs.count() > 0
    assert spark.read.parquet(want).count() > late.count()


def test_repeated_batch_has_the_same_state(spark, messages, known, model, rows, tmp_path):
    """The commit of the last batch gets lost; the restarted query runs it again from the state before it."""
    kept = ["batch_id", "bid_id", "keyword_name", *FEATURE_COLUMNS, *PREDICTION_COLUMNS]
    root = tmp_path / "again"
    table, _ = scored_with_state(spark, messages, known, model, root, [0, 500, 1000])
    once = rows(spark.read.parquet(table).select(kept))
    (root / "cp" / "commits" / "1").unlink()
    for crc in (root / "cp" / "commits").glob(".1.crc"):
        crc.unlink()
    stream = file_stream(spark, str(root / "source"), MESSAGE_SCHEMA)
    jobs.score_stream_with_state(spark, stream, None, known, model, table, str(root / "docs"), str(root / "rejects"), str(root / "cp"), once=True).awaitTermination()
    assert rows(spark.read.parquet(table).select(kept)) == once
    with pytest.raises(ValueError, match="first_batch=2"):
        jobs.score_stream_with_state(spark, stream, None, known, model, table, str(root / "docs"), str(root / "rejects"), str(tmp_path / "cp2"), once=True)


def test_stairs_give_the_maximum_as_of_any_time():
    rng = random.Random(5)
    points = [(rng.randrange(40), rng.choice("abcdefgh")) for _ in range(200)]
    steps = state.stairs(points)
    assert steps == state.stairs(points[:100] + state.stairs(points[100:])) and len(steps) <= 8
    for cutoff in range(-1, 42):
        assert state.as_of(steps, cutoff) == max((v for t, v in points if t <= cutoff), default=None)


def test_running_counts_equal_batch_counts_after_each_run(spark, messages, rows, tmp_path):
    out, source = str(tmp_path / "out"), str(tmp_path / "source")
    for part in range(3):
        some = messages.where(F.col("offset") % 3 == part)
        some.coalesce(1).write.mode("append").parquet(source)
        query = jobs.count_words_running(file_stream(spark, source, MESSAGE_SCHEMA), out, str(tmp_path / "cp"), once=True)
        query.awaitTermination()
        wanted = text.word_count(messages.where(F.col("offset") % 3 <= part))
        assert rows(serving.current_rows(spark, out, [], ["word"]).select("word", "n")) == rows(wanted)
        assert query.lastProgress["numInputRows"] == some.count()
    assert serving.batches(spark, out) == [0, 1, 2]
    # A word that a batch does not hold is not written again.
    assert spark.read.parquet(f"{out}/batch_id=2").count() < spark.read.parquet(out).select("word").distinct().count()


def test_points_of_many_users_are_reduced_at_once():
    """The same stairs as user by user, for users who come with a row each, and without a loop over them."""
    rng = random.Random(5)
    rows = [
        (f"u{rng.randrange(40)}", rng.random() < 0.3, rng.randrange(30), *(rng.choice([None, "0", "10", "9", "ä", "\U0001f600", "\uffff"]) for _ in FEATURE_COLUMNS))
        for _ in range(400)
    ]
    frame = pd.DataFrame(rows, columns=["ipinyou_id", "seed", "millis", *FEATURE_COLUMNS])
    wanted = []
    for user, seed in {(r[0], r[1]) for r in rows}:
        mine = [r for r in rows if r[:2] == (user, seed)]
        wanted += [] if seed else [(user, seed, state.CUTOFF, max(r[2] for r in mine), None)]
        for slot in range(len(FEATURE_COLUMNS)):
            wanted += [(user, seed, slot, *step) for step in state.stairs([(r[2], r[3 + slot]) for r in mine if r[3 + slot] is not None])]
    (got,) = state._reduced(iter([frame.iloc[:0], frame]))
    assert sorted(map(str, got.itertuples(index=False, name=None))) == sorted(map(str, wanted))
    users = pd.DataFrame({"ipinyou_id": [f"u{i}" for i in range(20_000)], "seed": False, "millis": range(20_000)} | {f: "0" for f in FEATURE_COLUMNS})
    began = time.process_time()
    (got,) = state._reduced(iter([users]))
    assert len(got) == 20_000 * (1 + len(FEATURE_COLUMNS)) and time.process_time() - began < 5  # 20 s and more, user by user
