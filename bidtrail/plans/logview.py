"""The given tables seen as a bid log, its dictionaries and other inputs of the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import event_time_text
from ..functions.useragent import BROWSERS, SYSTEMS
from ..operators.dictionaries import Dictionaries, keyword_dictionary
from ..schemas import BATCH_LAYOUT, RAW_LAYOUT, STREAM_LAYOUT

# The user agents the log view cycles through, one per event_id modulo 4.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.1 (KHTML, like Gecko) Chrome/21.0.1180.89 Safari/537.1",
    "Mozilla/5.0 (Linux; U; Android 4.0.4; zh-cn; 7266 Build/IMM76I) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Mobile Safari/534.30",
    "Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1; Trident/4.0)",
    "Mozilla/5.0 (Windows NT 5.1) AppleWebKit/537.1 (KHTML, like Gecko) Chrome/21.0.1180.89 Safari/537.1",
]

# Log type of each event type.
LOG_TYPES = {
    "click": (1, "bid-click"),
    "view": (2, "site-open"),
    "error": (3, "site-search"),
    "signup": (4, "site-click"),
    "purchase": (5, "site-lead"),
}
RECENT_DAYS = 10
TOPIC = "events"
PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_event_type(position: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {entry[position]!r}" for name, entry in LOG_TYPES.items())
    return f"CASE event_type {cases} END"


def log_columns(events: DataFrame) -> DataFrame:
    """Events as log rows without a city; works on a table or a stream."""
    agents = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(USER_AGENTS))
    based = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return based.withColumn("kt", F.col("k").cast("string")).select(
        "event_id",
        "user_id",
        F.col("event_id").cast("string").alias("bid_id"),
        event_time_text(F.col("ts")).alias("timestamp"),
        *map(
            F.expr,
            [
                "cast(user_id AS string) AS ipinyou_id",
                f"CASE event_id % 4 {agents} END AS user_agent",
                "concat('10.0.', user_id % 256, '.', kt) AS ip",
                "cast(user_id % 35 AS int) AS region",
                "cast(CASE WHEN event_id % 5 = 0 THEN -1 - k ELSE k END AS int) AS ad_exchange_id",
                "concat('site', k % 10, '.example') AS domain",
                "concat('http://site', k % 10, '.example/', kt) AS url",
                "CASE WHEN event_id % 2 = 1 THEN concat('anon', kt) END AS anonymous_url_id",
                "concat('slot', k % 7) AS ad_slot_id",
                "CASE WHEN event_id % 11 <> 0 THEN 100 + (k % 5) * 50 END AS ad_slot_width",
                "CASE WHEN event_id % 13 <> 0 THEN 50 + (k % 3) * 25 END AS ad_slot_height",
                "cast(event_id % 3 AS int) AS ad_slot_visibility",
                "cast(event_id % 2 AS int) AS ad_slot_format",
                "cast(k * 10 AS bigint) AS ad_slot_floor_price",
                "concat('cr', kt) AS creative_id",
                "cast(value AS float) AS bidding_price",
                "cast(1000 + user_id % 50 AS bigint) AS advertiser_id",
                """CASE WHEN event_id % 10 = 7 THEN NULL
                    WHEN event_id % 4 = 0 THEN kt
                    WHEN event_id % 4 = 1 THEN concat('0', kt)
                    WHEN event_id % 4 = 2 THEN concat(kt, ',', k + 1)
                    ELSE concat('9', lpad(kt, 14, '0')) END AS user_tags""",
                f"{_by_event_type(0)} AS log_type_id",
                f"{_by_event_type(1)} AS log_type_name",
                "cast(CASE WHEN event_id % 6 <> 0 THEN value / 2 END AS float) AS paying_price",
                "CASE WHEN event_id % 3 = 0 THEN concat('http://key.example/', kt) END AS key_page_url",
            ],
        ),
    )


def with_city(rows: DataFrame, customer: DataFrame) -> DataFrame:
    """city_id of the customer with the user's number; -1 for one event in nine and for unknown users."""
    places = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("_nation"))
    city = F.when(F.col("event_id") % 9 == 0, F.lit(-1)).otherwise(F.coalesce("_nation", F.lit(-1))).cast("int")
    return rows.join(places, "user_id", "left").withColumn("city_id", city).drop("_nation")


def bid_log(
    spark: SparkSession, sf_dir: str, layout: list[str] = STREAM_LAYOUT, events: DataFrame | None = None
) -> DataFrame:
    """The whole events table (or a given part) as typed log rows in a layout."""
    events = table(spark, sf_dir, "events") if events is None else events
    rows = with_city(log_columns(events), table(spark, sf_dir, "customer"))
    if layout == BATCH_LAYOUT:
        rows = rows.withColumn("predict", F.when(F.col("event_id") % 2 == 0, "TRUE").otherwise("FALSE"))
    return rows.select(*layout)


def as_lines(rows: DataFrame, columns: list[str]) -> Column:
    """Tab-separated line of some columns; a null is an empty field."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def dictionaries(spark: SparkSession, sf_dir: str) -> Dictionaries:
    """supplier as exchanges, nation as cities, region as states, part and supplier as keywords."""
    supplier, nation, region = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    city = nation.select(
        n.alias("city_id"),
        F.col("n_name").alias("city_name"),
        r.alias("state_id"),
        ((n + 1) * 1000).cast("bigint").alias("population"),
        (n * 1.5).cast("float").alias("area"),
        (n * 0.25).cast("float").alias("density"),
        F.when(n % 7 != 3, n * 1.25 - 10).cast("float").alias("latitude"),
        (r * 10.5 - n).cast("float").alias("longitude"),
    )
    state = region.select(
        F.col("r_regionkey").alias("state_id"),
        F.col("r_name").alias("state_name"),
        ((F.col("r_regionkey") + 1) * 1_000_000).cast("bigint").alias("state_population"),
        ((F.col("r_regionkey") + 1) * 5000).cast("bigint").alias("state_gsp"),
    )
    exchange = supplier.select(
        F.col("s_suppkey").cast("int").alias("ad_exchange_id"),
        F.col("s_name").alias("ad_exchange_name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("ad_exchange_desc"),
    )
    # As VALUES, not from Python objects: Spark knows the size of the former and broadcasts it.
    values = ", ".join(f"({number}, '{name}')" for number, name in LOG_TYPES.values())
    log_type = spark.sql(f"SELECT * FROM VALUES {values} AS t(log_type_id, log_type_name)")
    return Dictionaries(exchange, log_type, city, state, keywords(spark, sf_dir))


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    pages = part.select(F.col("p_partkey").alias("site_page_id"), F.col("p_name").alias("site_page_tag"))
    tags = supplier.select(
        F.col("s_suppkey").alias("user_profile_tag_id"), F.col("s_name").alias("user_profile_tag_value")
    )
    return keyword_dictionary(pages, tags)


def as_history(events: DataFrame) -> DataFrame:
    """Events as history rows; the raw tag text is the keyword."""
    return log_columns(events).select(
        "bid_id", "ipinyou_id", "timestamp", "log_type_name", F.col("user_tags").alias("keyword_name")
    )


def recent_start(spark: SparkSession, sf_dir: str) -> Column:
    """First instant of the last RECENT_DAYS days of the events table, as a scalar subquery.

    Compared with the ts column it becomes a row-group filter of the scan when the query runs.
    """
    latest = table(spark, sf_dir, "events").agg(F.max("ts").alias("ts"))
    start = F.date_trunc("MILLISECOND", F.col("ts") - F.expr(f"INTERVAL {RECENT_DAYS} DAYS"))
    return latest.select(start.cast("timestamp_ntz")).scalar()


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last RECENT_DAYS days: the new batch of the history queries."""
    return table(spark, sf_dir, "events").where(F.col("ts") >= recent_start(spark, sf_dir))


def older_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events before the last RECENT_DAYS days."""
    return table(spark, sf_dir, "events").where(F.col("ts") < recent_start(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: the event number is the offset, the user number picks the partition."""
    return as_event_messages(table(spark, sf_dir, "events"))


def as_event_messages(events: DataFrame, value: Column | None = None) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        (F.col("props") if value is None else value).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def log_messages(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Events (a table or a stream) as messages that carry a log line of the stream layout."""
    rows = with_city(log_columns(events), table(spark, sf_dir, "customer"))
    return rows.select(
        F.col("ipinyou_id").alias("key"),
        as_lines(rows, STREAM_LAYOUT).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def raw_lines(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events as raw-layout lines; some lines are cut after 20 fields, some have a 25th."""
    rows = bid_log(spark, sf_dir, RAW_LAYOUT, events)
    event = F.col("bid_id").cast("bigint")
    parts = rows.select(
        event.alias("event"),
        as_lines(rows, RAW_LAYOUT[:20]).alias("start"),
        as_lines(rows, RAW_LAYOUT[20:]).alias("end"),
        F.when(event % 19 == 0, "extra").alias("extra"),
    )
    return parts.select(F.when(F.col("event") % 17 == 0, F.col("start")).otherwise(F.concat_ws("\t", "start", "end", "extra")).alias("value"))


def damaged_messages(messages: DataFrame) -> DataFrame:
    """Log messages of which some are cut after 20 fields and some hold a width that is no number."""
    fields = F.split("value", "\t")
    cut = F.array_join(F.slice(fields, 1, 20), "\t")
    wide = F.array_join(F.concat(F.slice(fields, 1, 12), F.array(F.lit("wide")), F.slice(fields, 14, 10)), "\t")
    bad = F.when(F.col("offset") % 17 == 0, cut).when(F.col("offset") % 23 == 0, wide)
    return messages.withColumn("value", F.coalesce(bad, "value"))


def rule_agents(events: DataFrame) -> DataFrame:
    """bid_id and a user-agent text for each event: the marks of one browser rule, a version, the marks of one system rule.

    event_id walks through all pairs of rules, one more of each standing for no rule; every other text is in capitals.
    """
    browsers = [" ".join([*[m for m in marks if m != before], before]) for _, marks, before, *_ in BROWSERS] + ["Thing/"]
    systems = [" ".join(marks) for _, marks, *_ in SYSTEMS] + ["Other"]
    event, k = F.col("event_id"), F.get_json_object("props", "$.k")
    browser = F.element_at(F.lit(browsers), (F.pmod(event, F.lit(len(browsers))) + 1).cast("int"))
    system = F.element_at(F.lit(systems), (F.pmod(F.floor(event / len(browsers)), F.lit(len(systems))) + 1).cast("int"))
    version = F.when(event % 3 == 0, F.concat(k, F.lit(".1.2"))).when(event % 3 == 1, F.concat(k, F.lit(".7"))).otherwise(k)
    agent = F.concat(browser, version, F.lit("; "), system)
    return events.select(event.cast("string").alias("bid_id"), F.when(event % 2 == 0, F.upper(agent)).otherwise(agent).alias("user_agent"))
