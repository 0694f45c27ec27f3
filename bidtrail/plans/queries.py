"""Registered queries: every operator over whole given tables.

Arrays are returned as scalars or joined text and floats as doubles, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import scalars as fn
from ..functions import useragent as ua
from ..operators import boosting, geo
from ..operators import dictionaries as dim
from ..operators import history as hist
from ..operators import messages as msg
from ..operators import parsing, ranking, serving, text, vectors
from ..schemas import BATCH_LAYOUT, BATCH_SCHEMA, FEATURE_COLUMNS, MESSAGE_SCHEMA, RAW_LAYOUT, RAW_SCHEMA
from ..session import passing, scratch_path, stored
from ..sources import files
from ..sources.messages import file_stream
from ..streaming import jobs
from . import logview as view
from . import scoring
from .enrichment import enrich_index_document, enrich_log, enrich_log_folder

Query = Callable[[SparkSession, str], DataFrame]
EVENT_DDL = "event_id bigint, user_id bigint, event_type string, value double, props string"
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]
TERM = "the"
STREAM_PARTS = 3


def comparable(df: DataFrame) -> DataFrame:
    """Floats as doubles, the point as two columns, other arrays as joined text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.name == "coordinates":
            columns += [F.get(column, F.lit(i)).cast("double").alias(f"coordinates{i}") for i in (0, 1)]
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.array_join(column, "|").alias(field.name))
        elif isinstance(field.dataType, T.FloatType):
            columns.append(column.cast("double").alias(field.name))
        else:
            columns.append(column)
    return df.select(*columns)


# Sources and files


def scan_typed_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "typed-tsv")
    view.table(spark, sf_dir, "events").select(*EVENT_COLUMNS).write.option("sep", "\t").option("header", "true").csv(path)
    return files.read_tsv(spark, path, EVENT_DDL, header=True)


def scan_untyped_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "untyped-tsv")
    serving.write_tsv(view.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props"), path)
    return files.read_untyped_tsv(spark, path)


def scan_log_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "log-folder")
    log = view.bid_log(spark, sf_dir, BATCH_LAYOUT).withColumn("log_date", F.substring("timestamp", 1, 8))
    serving.write_tsv(log.hint("rebalance", "log_date"), path, partition_by="log_date")
    return comparable(files.read_log_folder(spark, path, BATCH_SCHEMA, day_folders=True))


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tsv")
    serving.write_tsv(view.table(spark, sf_dir, "events").select(*EVENT_COLUMNS), path)
    return files.read_tsv(spark, path, EVENT_DDL)


LINE_COLUMNS = ["bid_id", "timestamp", "ipinyou_id", "user_agent", "ip", "domain", "url"]


def publish_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, topic = scratch_path(spark, "lines"), scratch_path(spark, "topic")
    rows = view.log_columns(view.table(spark, sf_dir, "events"))
    rows.select(view.as_lines(rows, LINE_COLUMNS).alias("value")).write.text(path)
    files.read_lines(spark, path).write.parquet(topic)
    return spark.read.parquet(topic)


# Parsing


def parse_log_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(parsing.parse_lines(view.raw_lines(spark, sf_dir), RAW_SCHEMA))


def parse_log_line_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parse_lines_as_strings(view.raw_lines(spark, sf_dir), RAW_SCHEMA)


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k")
    odd = event % 3 == 0
    texts = {
        "as_int": (F.when(odd, F.concat(k, F.lit("x"))).otherwise(k), T.IntegerType()),
        "as_long": (F.when(odd, F.lit("")).otherwise(F.concat(k, F.lit("00000000000"))), T.LongType()),
        "as_float": (F.when(odd, F.lit("n/a")).otherwise(F.concat(k, F.lit(".5"))), T.FloatType()),
        "as_double": (F.when(odd, F.lit("null")).otherwise(F.concat(k, F.lit(".25"))), T.DoubleType()),
        "as_boolean": (F.when(odd, F.lit("TRUE")).when(event % 3 == 1, F.lit("yes")).otherwise(F.lit("false")), T.BooleanType()),
        "as_short": ((event % 50000).cast("string"), T.ShortType()),
        "as_byte": ((event % 300).cast("string"), T.ByteType()),
        "as_binary": (F.col("event_type"), T.BinaryType()),
        "as_time": (
            F.when(odd, F.lit("2024-02-30 10:00:00")).otherwise(F.concat(F.lit("2024-01-0"), (event % 9 + 1).cast("string"), F.lit(" 10:00:00"))),
            T.TimestampNTZType(),
        ),
        "as_texts": (F.concat(k, F.lit(",b,,")), T.ArrayType(T.StringType())),
        "as_floats": (F.concat(k, F.lit(".5,"), (user % 8).cast("string")), T.ArrayType(T.FloatType())),
    }
    cast = view.table(spark, sf_dir, "events").select(
        "event_id", *[fn.cast_text(text_, type_).alias(name) for name, (text_, type_) in texts.items()]
    )
    return comparable(
        cast.withColumns(
            {
                "as_short": F.col("as_short").cast("int"),
                "as_byte": F.col("as_byte").cast("int"),
                "as_binary": F.hex("as_binary"),
                "as_time": fn.event_time_text(F.col("as_time")),
                "as_floats": F.aggregate("as_floats", F.lit(0.0), lambda total, x: total + x),
            }
        )
    )


def filter_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(F.col("props")).alias("value")
    )
    return parsing.drop_empty(lines)


# Streams and messages


def _stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream.  As a pattern the path may name a file as well as a folder."""
    return file_stream(spark, f"{sf_dir}/{name}.parque[t]", view.table(spark, sf_dir, name).schema)


def _finished(query, spark: SparkSession, path: str) -> DataFrame:
    query.awaitTermination()
    return spark.read.parquet(path)


def stream_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-source")
    messages = view.as_event_messages(_stream_table(spark, sf_dir, "events"))
    return _finished(jobs.to_files(messages, out, f"{out}-checkpoint", once=True), spark, out)


def stream_term_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-term")
    posts = _stream_table(spark, sf_dir, "conversations").where(fn.matches_term(F.col("text"), TERM))
    return _finished(jobs.to_files(posts, out, f"{out}-checkpoint", once=True), spark, out)


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "raw-landing")
    messages = view.as_event_messages(_stream_table(spark, sf_dir, "events"))
    landed = _finished(jobs.land_raw(messages, out, f"{out}-checkpoint", once=True), spark, out)
    return landed.select(F.length("key").alias("key_length"), "value")


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-words")
    lines = _stream_table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    counts = _finished(jobs.count_words(lines, out, f"{out}-checkpoint", once=True), spark, out)
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def stream_word_count_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all words of the documents, kept as state over three micro-batches in runs of their own."""
    source, out = scratch_path(spark, "running-source"), scratch_path(spark, "running-words")
    lines = view.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))
    for part in range(STREAM_PARTS):
        lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(STREAM_PARTS)) == part).select("value").write.mode("append").parquet(source)
        jobs.count_words_running(file_stream(spark, source, T.StructType.fromDDL("value string")), out, f"{out}-checkpoint", once=True).awaitTermination()
    return serving.current_rows(spark, out, [], ["word"])


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-enrich")
    messages = view.log_messages(spark, sf_dir, _stream_table(spark, sf_dir, "events"))
    known = view.dictionaries(spark, sf_dir)
    query = jobs.enrich_stream(messages, known, out, f"{out}-rejects", f"{out}-checkpoint", once=True)
    return comparable(_finished(query, spark, out).drop("batch_id"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the enriching stream keeps aside of lines of which some are damaged."""
    out = scratch_path(spark, "stream-rejects")
    messages = view.damaged_messages(view.log_messages(spark, sf_dir, _stream_table(spark, sf_dir, "events")))
    query = jobs.enrich_stream(messages, view.dictionaries(spark, sf_dir), out, f"{out}-rejects", f"{out}-checkpoint", once=True)
    return _finished(query, spark, f"{out}-rejects").select("bid_id", "ipinyou_id", "timestamp", "ad_slot_width", "ad_slot_height", "reject_reason")


def stream_index_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-index")
    lines = view.raw_lines(spark, sf_dir, _stream_table(spark, sf_dir, "events"))
    query = jobs.index_stream(lines, view.dictionaries(spark, sf_dir), out, f"{out}-rejects", f"{out}-checkpoint", once=True)
    return comparable(_finished(query, spark, out).drop("batch_id"))


def keyword_stream_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the JSON documents that the keyword stream writes."""
    out = scratch_path(spark, "keyword-docs")
    messages = view.log_messages(spark, sf_dir, _stream_table(spark, sf_dir, "events"))
    jobs.keyword_documents(messages, view.dictionaries(spark, sf_dir), out, f"{out}-rejects", f"{out}-checkpoint", once=True).awaitTermination()
    docs = spark.read.text(out).withColumnRenamed("value", "doc")
    fields = ("bid_id", "ipinyou_id", "keyword_name", "city_name", "state_name", "log_type_name")
    return docs.select(*[F.get_json_object("doc", f"$.{f}").alias(f) for f in fields], F.col("doc").contains('"ad_slot_width"').alias("has_width"))


def log_folder_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files in day folders, enriched and written as one table."""
    path, table = scratch_path(spark, "log-files"), scratch_path(spark, "log-table")
    log = view.bid_log(spark, sf_dir, BATCH_LAYOUT).withColumn("log_date", F.substring("timestamp", 1, 8))
    serving.write_tsv(log.hint("rebalance", "log_date"), path, partition_by="log_date")
    enrich_log_folder(spark, path, view.dictionaries(spark, sf_dir), table, f"{table}-rejects", day_folders=True)
    return comparable(spark.read.parquet(table))


def bounded_offset_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.bounded_read(view.messages(spark, sf_dir), view.TOPIC, partition=1, start=100, limit=50)


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.offset_ranges(view.messages(spark, sf_dir))


def cell_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = view.table(spark, sf_dir, "events").select(
        F.col("props").alias("value"),
        (F.col("user_id") % view.PARTITIONS).alias("partition"),
        F.col("event_id").alias("offset"),
        fn.event_millis(F.col("ts")).alias("millis"),
    )
    return msg.cell_layout(timed, "millis", "flume_data", "col1", prefix="ts")


# Dictionaries and enrichment


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.log_columns(view.table(spark, sf_dir, "events"))


def join_dim_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = view.dictionaries(spark, sf_dir)
    log = _log(spark, sf_dir).select("bid_id", "ad_exchange_id", "log_type_id")
    joined = dim.join_log_type(dim.join_exchange(log, known.ad_exchange), known.log_type)
    return joined.select("bid_id", "ad_exchange_id", "ad_exchange_name", "ad_exchange_desc", "log_type_name")


def join_city_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = view.dictionaries(spark, sf_dir).city
    return comparable(dim.join_city(view.bid_log(spark, sf_dir), city).select("bid_id", *city.columns))


def join_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = view.dictionaries(spark, sf_dir)
    joined = dim.join_state(dim.join_city(view.bid_log(spark, sf_dir), known.city), known.state)
    return joined.select("bid_id", "city_name", "state_id", "state_name", "state_population", "state_gsp")


def join_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).select("bid_id", "user_tags")
    keyword = view.keywords(spark, sf_dir)
    return log.join(keyword, fn.tag_key(F.col("user_tags")) == keyword["keyword_id"], "left")


def keyword_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).select("bid_id", "user_tags")
    return dim.join_keyword(log, view.keywords(spark, sf_dir))


def keyword_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.keywords(spark, sf_dir)


def _enriched(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return enrich_log(view.bid_log(spark, sf_dir, BATCH_LAYOUT), view.dictionaries(spark, sf_dir), **options)


def enrich_bid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_enriched(spark, sf_dir, extra=["predict"], slot_size=True))


def enrich_index_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view.raw_lines(spark, sf_dir)
    raw = parsing.accepted(parsing.parse_lines_as_strings(lines, RAW_SCHEMA))
    return comparable(enrich_index_document(raw, view.dictionaries(spark, sf_dir)))


# Scalars


def geo_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = view.dictionaries(spark, sf_dir).city
    return comparable(city.select("city_id", fn.geo_point(F.col("latitude"), F.col("longitude")).alias("coordinates")))


def ad_slot_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = view.table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("w"), (F.col("p_size") * 2).alias("h")
    )
    return part.select("p_partkey", fn.ad_slot_size(F.col("w"), F.col("h")).alias("ad_slot_size"))


def user_tags_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, k = F.col("event_id"), F.get_json_object("props", "$.k")
    tags = (
        F.when(event % 5 == 0, F.concat(k, F.lit(",b,,")))
        .when(event % 5 == 1, F.lit(","))
        .when(event % 5 == 2, F.lit(""))
        .when(event % 5 == 3, F.concat(F.lit(",a,,"), k))
    )
    arrays = view.table(spark, sf_dir, "events").select("event_id", fn.user_tags_array(tags).alias("tags"))
    return arrays.select("event_id", F.size("tags").alias("n_tags"), F.array_join("tags", "|").alias("tags"))


def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    made = view.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 7 == 0, F.lit("null")).when(event % 7 == 1, F.lit("")).otherwise(fn.event_time_text(F.col("ts"))).alias("text"),
    )
    timed = made.withColumn("time", fn.event_time(F.col("text")))
    return timed.select("event_id", "text", fn.event_millis(F.col("time")).alias("millis"))


def ua_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ua.add_user_agent_columns(_log(spark, sf_dir).select("bid_id", "user_agent"), with_type=True)


def ua_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every browser and system rule, on texts that reach them."""
    return ua.add_user_agent_columns(view.rule_agents(view.table(spark, sf_dir, "events")), with_type=True)


def ua_enrich_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out = scratch_path(spark, "agents"), scratch_path(spark, "agents-parsed")
    serving.write_tsv(_log(spark, sf_dir).select("bid_id", "timestamp", "ipinyou_id", "ip", "user_agent"), source)
    serving.write_tsv(ua.add_four_agent_columns(files.read_untyped_tsv(spark, source), "_c4"), out)
    return files.read_untyped_tsv(spark, out)


# User history


def _history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = view.table(spark, sf_dir, "events")
    return view.as_history(events), view.as_history(view.recent_events(spark, sf_dir))


def history_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, batch = _history(spark, sf_dir)
    return hist.reduce_history(rows, batch)


def history_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.history_until_cutoff(*_history(spark, sf_dir))


def user_keyword_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hist.user_features(*_history(spark, sf_dir))


def attach_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, batch = _history(spark, sf_dir)
    return hist.attach_features(batch, hist.user_features(rows, batch), ["bid_id"])


def user_keyword_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view.as_history(view.table(spark, sf_dir, "events"))
    return hist.keyword_asof(rows).select("bid_id", "ipinyou_id", "timestamp", *FEATURE_COLUMNS)


# Aggregates and text


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(view.table(spark, sf_dir, "documents"), "text")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.table(spark, sf_dir, "documents").agg(F.count("*").alias("n"))


def keyword_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.index_terms(view.keywords(spark, sf_dir), "keyword_name").select("keyword_id", "term")


def keyword_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.token_positions(view.keywords(spark, sf_dir), "keyword_name").select("keyword_id", "term", "position")


def keyword_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stem and position of every word of the keywords."""
    return text.analysed_terms(view.keywords(spark, sf_dir), "keyword_name").select("keyword_id", "term", "stem", "position")


RADIUS_KM = 800.0


def cities_near_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities of the dictionary around a made-up point of every customer."""
    key = F.col("c_custkey")
    points = view.table(spark, sf_dir, "customer").select(
        "c_custkey", (key * 7919 % 18001 / 100 - 90).alias("lat"), (key * 104729 % 36001 / 100 - 180).alias("lon")
    )
    cities = view.dictionaries(spark, sf_dir).city
    cities = cities.select("city_id", F.col("latitude").cast("double").alias("city_lat"), F.col("longitude").cast("double").alias("city_lon"))
    found = geo.within_radius(points, cities, RADIUS_KM, ("lat", "lon"), ("city_lat", "city_lon"))
    return found.select("c_custkey", "city_id", F.round("distance_km", 3).alias("km"))


def offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and repeats in the offsets of two readers' batches, of 1,000 and of 1,700 offsets."""
    messages = view.messages(spark, sf_dir)
    read = [
        messages.where(F.col("offset") % 10_000 < until).withColumn("topic", F.concat("topic", F.lit("-"), F.floor(F.col("offset") / size).cast("string")))
        for size, until in ((1000, 6000), (1700, 9000))
    ]
    ranges = msg.offset_ranges(read[0].unionByName(read[1].withColumn("topic", F.concat("topic", F.lit("-b")))))
    return msg.ledger_report(ranges.withColumn("topic", F.substring_index("topic", "-", 1)))


# Serving


def serving_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "serving")
    serving.overwrite_table(_enriched(spark, sf_dir, extra=["predict"], user_agent=False), path)
    return comparable(spark.read.parquet(path))


def _served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows as the serving table holds them, with made-up probabilities."""
    rows = view.as_history(view.table(spark, sf_dir, "events"))
    featured = hist.attach_features(rows, hist.user_features(rows, rows), ["bid_id"])
    sure = F.col("bid_id").cast("bigint") % 4
    return featured.withColumns(
        {
            "predict": F.when(sure >= 2, "TRUE").otherwise("FALSE"),
            "true_prob": F.when(sure != 3, sure / 4),
            "false_prob": F.when(sure != 3, 1 - sure / 4),
        }
    )


def serving_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "serving-read")
    serving.append_batch(_served(spark, sf_dir), path, 0)
    return serving.serving_report(serving.current_rows(spark, path, ["bid_id"]))


def serving_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = serving.serving_schema(_served(spark, sf_dir))
    return typed.select(
        "bid_id", fn.event_millis(F.col("event_time")).alias("event_millis"), "predict", "false_prob", "true_prob"
    )


def serving_text_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key-value form of enriched rows: all columns as text."""
    rows = hist.with_no_features(_enriched(spark, sf_dir, extra=["predict"]))
    none = F.lit(None).cast("double")
    texts = serving.serving_text_row(rows.withColumns({"false_prob": none, "true_prob": none}))
    # Texts of fractions are compared as numbers; engines write small and large ones differently.
    fractions = {f.name for f in rows.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))} | {"coordinates0", "coordinates1"}
    return texts.select(*[F.col(c).cast("double").alias(c) if c in fractions else c for c in texts.columns])


UPSERT_KEY = ["ipinyou_id", "log_date"]


def _daily_rows(events: DataFrame) -> DataFrame:
    return view.log_columns(events).select(
        "ipinyou_id", F.substring("timestamp", 1, 8).alias("log_date"), "timestamp",
        F.col("bid_id").cast("bigint").alias("arrival"), "user_tags",
    )


def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, then the last days again with a mark, that batch twice; one row per user and day stays."""
    path = scratch_path(spark, "upsert")
    marked = F.concat(F.lit("new:"), F.coalesce("user_tags", F.lit("none")))
    newer = _daily_rows(view.recent_events(spark, sf_dir)).withColumn("user_tags", marked)
    serving.append_batch(_daily_rows(view.table(spark, sf_dir, "events")), path, 0)
    for _ in range(2):
        serving.append_batch(newer, path, 1)
    return serving.current_rows(spark, path, ["arrival"], UPSERT_KEY)


def serving_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after deleting the users in debt."""
    table, kept = scratch_path(spark, "delete-from"), scratch_path(spark, "delete-kept")
    serving.overwrite_table(_daily_rows(view.table(spark, sf_dir, "events")), table)
    ids = view.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("ipinyou_id"))
    serving.overwrite_table(serving.delete_ids(spark.read.parquet(table), ids, "ipinyou_id"), kept)
    return spark.read.parquet(kept)


def serving_delete_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, read through marks of the deleted users; the table folded without them, read again."""
    path, folded = scratch_path(spark, "marked"), scratch_path(spark, "marked-folded")
    serving.append_batch(_daily_rows(view.table(spark, sf_dir, "events")), path, 0)
    ids = view.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("ipinyou_id"))
    serving.append_deletes(ids, path, 1, "ipinyou_id")
    every = ["ipinyou_id", "arrival"]
    serving.compact_live(spark, path, folded, [], "ipinyou_id", every)
    return serving.live_rows(spark, folded, [], "ipinyou_id", every)


def serving_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first customer of each nation, looked up in a table laid out by user in two batches."""
    path = scratch_path(spark, "lookup")
    rows = _daily_rows(view.table(spark, sf_dir, "events"))
    for batch in (0, 1):
        serving.append_batch(rows.where(F.col("arrival") % 2 == batch), path, batch, by_user=True)
    first = view.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_custkey").alias("user"))
    users = [str(r["user"]) for r in first.collect()]  # one per nation
    return serving.current_rows_of_users(spark, path, users, [], ["ipinyou_id", "arrival"])


def daily_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "daily")
    name = F.concat(F.lit("site-click."), F.substring("timestamp", 1, 8), F.lit("-aa.txt"))
    routed = _log(spark, sf_dir).select(
        "bid_id", fn.date_in_name(name).alias("log_date"), fn.index_for_name(name, "log_%s/bid").alias("index_name")
    )
    serving.write_daily(routed, path)
    rows = spark.read.schema("bid_id string, index_name string, log_date string").parquet(path)
    return rows.select("bid_id", "index_name", "log_date")


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = serving.json_documents(_enriched(spark, sf_dir, user_agent=False))
    field = lambda path: F.get_json_object("doc", path)
    return docs.select(
        field("$.bid_id").alias("bid_id"),
        field("$.keyword_name").alias("keyword_name"),
        field("$.city_name").alias("city_name"),
        field("$.coordinates[0]").cast("double").alias("longitude"),
        F.col("doc").contains('"anonymous_url_id"').alias("has_anonymous_url"),
        F.col("doc").contains('"ad_exchange_name"').alias("has_exchange"),
    )


# Models


def _leads(spark: SparkSession, sf_dir: str, events: DataFrame, past: DataFrame) -> DataFrame:
    """Enriched log rows with their users' features from a past, and the label."""
    rows = enrich_log(view.bid_log(spark, sf_dir, events=events), view.dictionaries(spark, sf_dir))
    featured = hist.attach_features(rows, hist.user_features(view.as_history(past), view.as_history(events)), ["bid_id"])
    return featured.withColumn("label", (F.col("log_type_name") == "site-lead").cast("double"))


def lead_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the model is fitted on: rows of the last RECENT_DAYS days, with the features of the time before."""
    return _leads(spark, sf_dir, view.recent_events(spark, sf_dir), view.older_events(spark, sf_dir))


def _scored_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows scored by a model that was fitted, saved and loaded."""
    path = scratch_path(spark, "lead-model")
    scoring.train_lead_model(lead_rows(spark, sf_dir), path)
    events = view.table(spark, sf_dir, "events")
    return scoring.score_leads(scoring.PipelineModel.load(path), _leads(spark, sf_dir, events, events))


def _sure() -> list[Column]:
    """Whether the two probabilities add up, and the prediction is the larger one's."""
    larger = F.when(F.col("true_prob") > F.col("false_prob"), "TRUE").otherwise("FALSE")
    return [(F.abs(F.col("false_prob") + F.col("true_prob") - 1) < 1e-9).alias("adds_up"), (F.col("predict") == larger).alias("larger_wins")]


def train_lead_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and leads that the model was fitted on, and whether the loss fell from step to step."""
    rows = lead_rows(spark, sf_dir)
    losses = scoring.train_lead_model(rows, scratch_path(spark, "lead-model")).stages[-1].summary().objectiveHistory
    fell = all(b <= a for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    return rows.agg(F.count("*").alias("n"), F.sum("label").cast("bigint").alias("leads"), F.lit(bool(fell)).alias("loss_fell"))


def score_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_leads(spark, sf_dir)
    return scored.select("bid_id", "ipinyou_id", "timestamp", F.col("label").cast("int").alias("label"), *_sure())


def mispredictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each class, whether its wrong predictions are what its right ones leave, and whether the model is wrong no
    more often than the most frequent class for all rows would be."""
    scored = stored(_scored_leads(spark, sf_dir).select(F.when(F.col("label") == 1, "TRUE").otherwise("FALSE").alias("actual"), "predict"))
    counted = stored(_errors_add_up(scored, "actual", "predict"))
    no_worse = counted.agg((F.sum("right") >= F.max("n")).alias("no_worse")).scalar()
    return counted.select("actual", "n", "errors_add_up", no_worse.alias("no_worse_than_one_class"))


def _errors_add_up(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    wrong = scoring.mispredictions(scored, actual, predicted).groupBy("actual").agg(F.sum("n").alias("wrong"))
    classes = scored.groupBy(F.col(actual).alias("class")).agg(F.count("*").alias("n"), F.count_if(F.col(actual) == F.col(predicted)).alias("right"))
    joined = classes.join(wrong, F.col("class") == F.col("actual"), "left").drop("actual").withColumnRenamed("class", "actual")
    return joined.withColumn("errors_add_up", F.col("right") + F.coalesce("wrong", F.lit(0)) == F.col("n"))


def train_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each class of the training table, whether errors add up, and whether the trees beat one class for all."""
    rows = view.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    scored = stored(scoring.train_boosted_trees(rows).transform(rows).select("label", "prediction"))
    return _beats_one_class(scored)


def _beats_one_class(scored: DataFrame) -> DataFrame:
    counted = _errors_add_up(scored, "label", "prediction")
    everything = Window.partitionBy(F.lit(0))  # a row per class
    better = F.sum("right").over(everything) > F.max("n").over(everything)
    return counted.select(F.col("actual").cast("int").alias("actual"), "n", "errors_add_up", better.alias("beats_one_class"))


def train_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees trained from a labelled file with a header line and a column per dimension; the same checks."""
    path = scratch_path(spark, "labelled")
    table = view.table(spark, sf_dir, "embeddings")
    dimensions = table.agg(F.max(F.size("embedding"))).first()[0] or 0
    table.select("label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(dimensions)]).write.option("header", "true").csv(path)
    rows = files.read_labelled_csv(spark, path)
    vector = array_to_vector(F.array(*[F.col(c) for c in rows.columns if c != "label"]))
    rows = rows.select(F.col("label").cast("double").alias("label"), vector.alias("features"))
    scored = stored(scoring.train_boosted_trees(rows).transform(rows).select("label", "prediction"))
    return _beats_one_class(scored)


def boost_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all classes at once on the training table: rows of each class, whether the loss fell in every round, and whether
    more rows are right than with one class for all."""
    rows = view.table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("features"))
    model = boosting.train(rows)
    fell = all(b < a for a, b in zip(model.losses, model.losses[1:]))
    counted = stored(_errors_add_up(boosting.predict(model, rows), "label", "prediction"))
    better = counted.agg((F.sum("right") > F.max("n")).alias("better")).scalar()
    return counted.select(F.col("actual").cast("int").alias("actual"), "n", F.lit(fell).alias("loss_fell"), better.alias("beats_one_class"))


def wrong_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value, cut at the threshold of the best F1, tells wrongly whether they are purchases."""
    value = F.round("value", 1)
    report = ranking.ranking_report(ranking.threshold_curve(_sales(spark, sf_dir)))
    rows = view.table(spark, sf_dir, "events").where(value.isNotNull() & F.col("event_type").isNotNull())
    cut = report.select("threshold").scalar()
    actual = F.when(F.col("event_type") == "purchase", "TRUE").otherwise("FALSE")
    told = rows.select("event_id", actual.alias("actual"), ranking.predicted_by(value, cut).alias("predicted"))
    return ranking.wrong_rows(told, "actual", "predicted", ["event_id"])


def _titles(conversations: DataFrame) -> DataFrame:
    roles = F.create_map(*[F.lit(x) for pair in (("user", 0.0), ("assistant", 1.0), ("system", 2.0)) for x in pair])
    return conversations.select("conv_id", "turn", F.col("text").alias("title"), F.element_at(roles, F.col("role")).alias("label"))


def classify_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "titles")
    titles = _titles(view.table(spark, sf_dir, "conversations"))
    model = scoring.title_pipeline().fit(titles)
    scored = scoring.classify_titles(model, parsing.drop_empty(_titles(_stream_table(spark, sf_dir, "conversations")), "title"))
    rows = _finished(jobs.to_files(scored, out, f"{out}-checkpoint", once=True), spark, out)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
    line = fn.prediction_text(F.col("title"), F.col("probabilities"))
    return rows.select(
        "conv_id",
        "turn",
        F.substring_index(line, '" = [', 1).alias("quoted"),
        (F.abs(total - 1) < 1e-9).alias("adds_up"),
        (F.get("probabilities", F.col("predicted")) == F.array_max("probabilities")).alias("larger_wins"),
    )


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector of every word of the conversations, as joined text."""
    return comparable(vectors.word_vectors(view.table(spark, sf_dir, "conversations"), "text"))


LANGUAGES = ["en", "fr", "de", "es"]
HELD_OUT = 4


def title_vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a stream classified by language from word vectors; per language the rows that the model had not seen,
    and whether nine in ten of them got their own one."""
    out = scratch_path(spark, "title-vectors")
    docs = view.table(spark, sf_dir, "documents")
    with passing(spark):
        known = stored(vectors.word_vectors(docs, "text"))
    label = F.array_position(F.lit(LANGUAGES), F.col("lang")) - 1
    seen = docs.where(F.col("doc_id") % HELD_OUT != 0).withColumn("label", label).where("label >= 0")
    with passing(spark):
        model = vectors.train_title_classifier(vectors.title_vectors(seen, known, "text"))
    query = jobs.classify_title_stream(_stream_table(spark, sf_dir, "documents"), known, model, out, f"{out}-checkpoint", column="text", once=True)
    classed = _finished(query, spark, out).where(F.col("doc_id") % HELD_OUT == 0).where(F.col("lang").isin(LANGUAGES))
    right = F.count_if(F.element_at(F.lit(LANGUAGES), F.col("predicted") + 1) == F.col("lang"))
    return classed.groupBy("lang").agg(F.count("*").alias("n"), (10 * right >= 9 * F.count("*")).alias("mostly_right"))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ranked by their value, with whether they are purchases."""
    events = view.table(spark, sf_dir, "events")
    return events.select((F.col("event_type") == "purchase").cast("int").alias("label"), F.round("value", 1).alias("score"))


def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.threshold_curve(_sales(spark, sf_dir))


def ranking_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranking_report(ranking.threshold_curve(_sales(spark, sf_dir)))


def lead_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads ranked by the model: rows of both kinds, and whether the best threshold gives an F1 as good as that of the
    model's own decision, counted row by row."""
    scored = stored(_scored_leads(spark, sf_dir).select(F.col("label").cast("int").alias("label"), F.col("true_prob").alias("score"), "predict"))
    report = ranking.ranking_report(ranking.threshold_curve(scored))
    own = scored.agg(F.count_if((F.col("label") == 1) & (F.col("predict") == "TRUE")).alias("own_tp"), F.count_if(F.col("predict") == "TRUE").alias("own_all"))
    own_f1 = 2.0 * F.col("own_tp") / (F.col("own_all") + F.col("positives"))
    return report.join(F.broadcast(own)).select("positives", "negatives", (F.col("f1") >= own_f1).alias("no_worse"))  # one row each


def _scored_table(spark: SparkSession, sf_dir: str, score: Callable[[DataFrame, scoring.PipelineModel, str], StreamingQuery]) -> DataFrame:
    """The table after the last days were scored in three micro-batches, each in a run of its own, on top of what came before."""
    table, source = scratch_path(spark, "scored"), scratch_path(spark, "scored-source")
    model = scoring.train_lead_model(lead_rows(spark, sf_dir))
    # Messages and parsed rows are stored: to make, parse and enrich lines in one stage is beyond what the JVM compiles.  Lines
    # are costlier than their bytes tell, so they are dealt out by number.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages = stored(view.log_messages(spark, sf_dir, view.older_events(spark, sf_dir)).repartition(tasks))
    older = jobs.served_rows(stored(jobs.parsed_rows(messages)), view.dictionaries(spark, sf_dir))
    serving.append_batch(scoring.score_leads(model, hist.with_no_features(older)), table, serving.BASE, by_user=True)
    recent = view.log_messages(spark, sf_dir, view.recent_events(spark, sf_dir))
    for part in range(STREAM_PARTS):  # each run finds the files of one part and works them off as one batch
        recent.where(F.col("offset") % STREAM_PARTS == part).write.mode("append").parquet(source)
        score(file_stream(spark, source, MESSAGE_SCHEMA), model, table).awaitTermination()
    current = serving.current_rows(spark, table, ["partition", "offset"])
    return current.select("ipinyou_id", "timestamp", *FEATURE_COLUMNS, *_sure())


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored with the users' features kept as state of the stream; the table is read once, before the first batch."""
    known, past = view.dictionaries(spark, sf_dir), scratch_path(spark, "scored-past")

    def score(messages: DataFrame, model: scoring.PipelineModel, table: str) -> StreamingQuery:
        if serving.batches(spark, table) == [serving.BASE]:
            serving.history_snapshot(serving.current_rows(spark, table, ["partition", "offset"]), past)
        history = file_stream(spark, past, T.StructType.fromDDL(hist.HISTORY_DDL))
        return jobs.score_stream_with_state(spark, messages, history, known, model, table, f"{table}-docs", f"{table}-rejects", f"{table}-checkpoint", once=True)

    return _scored_table(spark, sf_dir, score)


def stream_score_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored with the features of the users of each batch read from the table."""
    known = view.dictionaries(spark, sf_dir)

    def score(messages: DataFrame, model: scoring.PipelineModel, table: str) -> StreamingQuery:
        return jobs.score_stream(spark, messages, known, model, table, f"{table}-docs", f"{table}-rejects", f"{table}-checkpoint", once=True)

    return _scored_table(spark, sf_dir, score)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_typed_tsv, scan_untyped_tsv, scan_log_dir, tsv_roundtrip, publish_lines,
        parse_log_line, parse_log_line_strings, typed_casts, filter_nonempty,
        stream_log_source, stream_term_filter, raw_landing, bounded_offset_read, offset_ranges, cell_layout,
        serving_read, serving_overwrite, serving_upsert, serving_delete, serving_lookup, daily_routing, json_documents,
        serving_schema, keyword_terms, keyword_positions, keyword_stems, cities_near_customers, offset_ledger, serving_delete_marks,
        enrich_bid_log, enrich_index_doc, join_dim_left, join_city_inner, join_snowflake, join_keyword,
        keyword_dictionary, keyword_fallback,
        history_range_join, history_semi_join, user_keyword_pivot, user_keyword_asof, attach_features,
        word_count, row_count, stream_word_count, stream_word_count_running,
        geo_point, ad_slot_size, user_tags_array, event_time, ua_enrich, ua_rules, ua_enrich_tsv,
        stream_enrich, stream_rejects, stream_index_doc, keyword_stream_docs, log_folder_job, serving_text_row,
        train_from_file, stream_score, stream_score_from_table, train_lead_model, score_leads, mispredictions, train_boosted_trees,
        classify_titles, word_vectors, title_vector_classes, threshold_curve, ranking_report, lead_threshold,
        boost_softmax, wrong_predictions,
    )
}
