"""Streaming jobs.

Each job takes a streaming frame and returns a started query.  `once=True` works off what is there and ends;
otherwise a micro-batch starts every `interval`.  The checkpoint folder makes a restart go on where the last
run stopped, and batch folders make a repeated batch replace itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dictionaries import Dictionaries
from ..operators.history import USER, as_past, attach_features, keyword_pivot, rows_until_cutoff
from ..operators.parsing import accepted, drop_empty, parse_lines, parse_lines_as_strings, rejected
from ..operators.serving import (
    BATCH,
    BUCKET,
    append_batch,
    batches,
    landing_rows,
    latest_per_key,
    stored_rows,
    table_buckets,
    user_bucket,
    write_documents,
)
from ..operators.text import word_count
from ..operators.vectors import classify_title_vectors, title_vectors
from ..plans.enrichment import enrich_index_document, enrich_log
from ..plans.scoring import score_leads
from ..schemas import FEATURE_COLUMNS, RAW_SCHEMA, SERVING_KEY, STREAM_SCHEMA
from .state import feature_points, followed_features, use_state_store

# Micro-batch interval of the workflow jobs.
INTERVAL = "10 seconds"


def _start(writer, once: bool, interval: str) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def to_files(stream: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = INTERVAL) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer, once, interval)


def per_batch(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Run `work(batch, batch_id)` for every micro-batch."""
    return _start(stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint), once, interval)


def land_raw(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep every message as it is under a random key."""
    return to_files(landing_rows(messages), path, checkpoint, **trigger)


def parse_stream(
    messages: DataFrame,
    schema: T.StructType,
    work: Callable[[DataFrame], DataFrame],
    path: str,
    rejects: str,
    checkpoint: str,
    as_text: bool = False,
    **trigger,
) -> StreamingQuery:
    """Parse each micro-batch once; good lines go through `work` to a table, all others with their reason to another.

    Both tables have one folder per batch, so a repeated batch replaces itself in both.
    """
    parse = parse_lines_as_strings if as_text else parse_lines

    def each(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(drop_empty(batch.select("value")), schema).persist()
        try:
            append_batch(work(accepted(parsed)), path, batch_id)
            append_batch(rejected(parsed), rejects, batch_id)
        finally:
            parsed.unpersist()

    return per_batch(messages, each, checkpoint, **trigger)


def enrich_stream(
    messages: DataFrame, dictionaries: Dictionaries, path: str, rejects: str, checkpoint: str, slot_size: bool = True, **trigger
) -> StreamingQuery:
    """Parse and enrich log lines; dictionaries are joined as static tables."""
    work = lambda log: enrich_log(log, dictionaries, slot_size=slot_size)
    return parse_stream(messages, STREAM_SCHEMA, work, path, rejects, checkpoint, **trigger)


def index_stream(messages: DataFrame, dictionaries: Dictionaries, path: str, rejects: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Raw log lines as index documents; the dictionaries stay loaded between batches."""
    work = lambda log: enrich_index_document(log, dictionaries)
    return parse_stream(messages, RAW_SCHEMA, work, path, rejects, checkpoint, as_text=True, **trigger)


def keyword_documents(
    messages: DataFrame, dictionaries: Dictionaries, path: str, rejects: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Log lines enriched with their keywords as JSON documents; a batch without rows writes none."""

    def each(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(drop_empty(batch.select("value")), STREAM_SCHEMA).persist()
        rows = enrich_log(accepted(parsed), dictionaries, user_agent=False).persist()
        try:
            append_batch(rejected(parsed), rejects, batch_id)
            if not rows.isEmpty():
                write_documents(rows, f"{path}/{BATCH}={batch_id}")
        finally:
            rows.unpersist()
            parsed.unpersist()

    return per_batch(messages, each, checkpoint, **trigger)


def count_words_running(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Word counts since the start of the stream.  A batch appends the new count of each of its words to a keyed table.

    Counts are state of the query, so a batch neither reads the table nor words of earlier batches; of each word
    the last batch counts (serving.current_rows).
    """
    use_state_store(messages.sparkSession)

    def work(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id)

    writer = word_count(messages).writeStream.outputMode("update").foreachBatch(work).option("checkpointLocation", checkpoint)
    return _start(writer, **{"once": False, "interval": INTERVAL, **trigger})


def count_words(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Word counts of each micro-batch, one folder per batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        append_batch(word_count(batch), path, batch_id)

    return per_batch(messages, work, checkpoint, **trigger)


def classify_title_stream(
    titles: DataFrame, vectors: DataFrame, model: LogisticRegressionModel, path: str, checkpoint: str, column: str = "title", **trigger
) -> StreamingQuery:
    """Titles classified by the vectors of their words; the vectors are joined as a static table."""

    def work(batch: DataFrame, batch_id: int) -> None:
        featured = title_vectors(batch.where(F.coalesce(column, F.lit("")) != ""), vectors, column)
        append_batch(classify_title_vectors(model, featured), path, batch_id)

    return per_batch(titles, work, checkpoint, **trigger)


def parsed_rows(messages: DataFrame) -> DataFrame:
    """Log lines of a batch with the message position that orders them, bad ones with their reason."""
    return parse_lines(drop_empty(messages.select("value", "partition", "offset")), STREAM_SCHEMA)


def served_rows(parsed: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """The good ones, enriched."""
    return enrich_log(accepted(parsed), dictionaries, extra=["partition", "offset"])


def score_stream(
    spark: SparkSession,
    messages: DataFrame,
    dictionaries: Dictionaries,
    model: PipelineModel,
    table: str,
    documents: str,
    rejects: str,
    checkpoint: str,
    first_batch: int = 0,
    **trigger,
) -> StreamingQuery:
    """Lead scoring with the serving table as memory between batches.

    A batch is parsed and enriched, gets its users' features from the table as it stood before the batch, is
    scored, and is written as documents and as the table's next batch, laid out by user; its rejects go to a table
    of their own.  The table must exist (it may be empty).  A repeated batch ignores what its first run wrote.

    Batches are numbered from first_batch on.  A new checkpoint counts from the start again, so it must be given a
    first_batch beyond the batches that the table holds; otherwise it would replace them, and the job refuses.
    """
    refuse_to_replace(spark, table, checkpoint, first_batch)
    stored_fields = spark.read.option("basePath", table).parquet(table).schema.fields
    columns = T.StructType([f for f in stored_fields if f.name not in (BATCH, BUCKET)])
    all_buckets = table_buckets(spark, table)

    def work(batch: DataFrame, number: int) -> None:
        held: list[DataFrame] = []
        batch_id = first_batch + number

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        try:
            parsed = hold(parsed_rows(batch))
            append_batch(rejected(parsed), rejects, batch_id)
            rows = hold(served_rows(parsed, dictionaries))
            buckets = [r[0] for r in rows.select(user_bucket(buckets=all_buckets)).distinct().collect()]  # no more than the table has
            if not buckets:
                return
            # Rows replaced by a later one are not history.
            stored = stored_rows(spark, table, batch_id, columns, buckets)
            past = latest_per_key(rows_until_cutoff(stored, rows, hold), SERVING_KEY, [BATCH, "partition", "offset"])
            featured = attach_features(rows, keyword_pivot(as_past(past)), ["bid_id"], hold)
            scored = hold(score_leads(model, featured))
            write_documents(scored.drop("partition", "offset"), f"{documents}/{BATCH}={batch_id}")
            append_batch(scored, table, batch_id, by_user=True)
        finally:
            for df in held:
                df.unpersist()

    return per_batch(messages, work, checkpoint, **trigger)


def score_stream_with_state(
    spark: SparkSession,
    messages: DataFrame,
    history: DataFrame | None,
    dictionaries: Dictionaries,
    model: PipelineModel,
    table: str,
    documents: str,
    rejects: str,
    checkpoint: str,
    first_batch: int = 0,
    **trigger,
) -> StreamingQuery:
    """Lead scoring with the users' features as state of the query: no batch reads a row of the past.

    history is a stream of what the table held before the query began (user, time, log type, keyword; see
    serving.history_snapshot), which the first batch takes into its state; None starts without.  Messages and
    features of a batch come together from one source.  A batch is written as by score_stream, and numbered likewise.
    """
    refuse_to_replace(spark, table, checkpoint, first_batch)
    use_state_store(spark)
    points = feature_points(served_rows(parsed_rows(messages), dictionaries))
    if history is not None:
        points = points.unionByName(feature_points(history, seed=True))
    read = messages.select("value", "partition", "offset", F.lit(True).alias("is_message"))
    both = read.unionByName(followed_features(points), allowMissingColumns=True)

    def work(batch: DataFrame, number: int) -> None:
        held: list[DataFrame] = []

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        try:
            whole = hold(batch)
            parsed = hold(parsed_rows(whole.where("is_message")))
            # Reads all of the batch, and so runs every task that keeps state.
            append_batch(rejected(parsed), rejects, first_batch + number)
            rows = hold(served_rows(parsed, dictionaries))
            if rows.isEmpty():
                return
            features = whole.where("is_message IS NULL").select(USER, *FEATURE_COLUMNS)
            scored = hold(score_leads(model, attach_features(rows, features, ["bid_id"], hold)))
            write_documents(scored.drop("partition", "offset"), f"{documents}/{BATCH}={first_batch + number}")
            append_batch(scored, table, first_batch + number, by_user=True)
        finally:
            for df in held:
                df.unpersist()

    return per_batch(both, work, checkpoint, **trigger)


def refuse_to_replace(spark: SparkSession, table: str, checkpoint: str, first_batch: int) -> None:
    """An error if a new checkpoint would number its batches like some that the table holds."""
    held_already = [b for b in batches(spark, table) if b >= first_batch]
    if held_already and not has_offsets(spark, checkpoint):
        raise ValueError(f"{table} already holds batch {held_already[-1]} of another checkpoint; start with first_batch={held_already[-1] + 1}")


def has_offsets(spark: SparkSession, checkpoint: str) -> bool:
    """Has a query with this checkpoint begun a batch?"""
    folder = spark._jvm.org.apache.hadoop.fs.Path(checkpoint, "offsets")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
