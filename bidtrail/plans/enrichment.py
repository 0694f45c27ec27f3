"""Enrichment of the bid log from its dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ad_slot_size, cast_text, geo_point, user_tags_array
from ..functions.useragent import add_user_agent_columns
from ..operators import dictionaries as dim
from ..operators.dictionaries import Dictionaries
from ..operators.parsing import accepted, rejected
from ..operators.serving import overwrite_table
from ..schemas import SERVED_BID_COLUMNS, SERVED_DICTIONARY_COLUMNS
from ..session import stored
from ..sources.files import read_log_lines


def enrich_log(
    log: DataFrame,
    dictionaries: Dictionaries,
    extra: list[str] | None = None,
    slot_size: bool = False,
    user_agent: bool = True,
    skip_null_users: bool = False,
) -> DataFrame:
    """Serving projection of typed log rows.

    18 log columns, 12 dictionary columns, then ad_slot_size and `extra` log columns if asked, then the
    user-agent columns.  Rows of an unknown city are dropped; other unknown ids give nulls.
    """
    if skip_null_users:
        log = log.where(F.col("ipinyou_id") != "null")
    joined = dim.join_state(dim.join_city(log, dictionaries.city), dictionaries.state)
    joined = dim.join_exchange(joined, dictionaries.ad_exchange)
    joined = dim.join_log_type(joined, dictionaries.log_type)
    joined = dim.join_keyword(joined, dictionaries.keyword)
    made = {"coordinates": geo_point(F.col("latitude"), F.col("longitude"))}
    if slot_size:
        made["ad_slot_size"] = ad_slot_size(F.col("ad_slot_width"), F.col("ad_slot_height"))
    names = [*SERVED_BID_COLUMNS, *SERVED_DICTIONARY_COLUMNS, *(["ad_slot_size"] if slot_size else []), *(extra or [])]
    served = joined.withColumns(made).select(*names)
    return add_user_agent_columns(served) if user_agent else served


def enrich_index_document(log: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """Index document of an untyped (all-text) raw log row.

    Every log column but the ids and region, every column of the four dictionaries once, the tags as an
    array, the point, and the user-agent columns.
    """
    ids = {"ad_exchange_id": "_exchange", "log_type_id": "_type", "city_id": "_city"}
    facts = log.select(
        *[c for c in log.columns if c not in ids and c != "region"],
        *[cast_text(F.col(c), T.IntegerType()).alias(alias) for c, alias in ids.items()],
        user_tags_array(F.col("user_tags")).alias("user_tags_array"),
    )
    city, exchange, kind = dictionaries.city, dictionaries.ad_exchange, dictionaries.log_type
    placed = facts.join(city, facts["_city"] == city["city_id"], "inner")
    joined = (
        dim.join_state(placed, dictionaries.state)
        .join(exchange, F.col("_exchange") == exchange["ad_exchange_id"], "left")
        .join(kind, F.col("_type") == kind["log_type_id"], "left")
        .withColumn("coordinates", geo_point(F.col("latitude"), F.col("longitude")))
        .drop(*ids.values())
    )
    return add_user_agent_columns(joined)


def enrich_log_folder(
    spark: SparkSession, log_folder: str, dictionaries: Dictionaries, table: str, rejects: str, day_folders: bool = False
) -> None:
    """Batch job: every log file below a folder, enriched and written as one table; bad lines to another.

    The lines are parsed once and stored between.
    """
    parsed = stored(read_log_lines(spark, log_folder, day_folders=day_folders))
    overwrite_table(enrich_log(accepted(parsed), dictionaries, extra=["predict", "log_date"]), table)
    overwrite_table(rejected(parsed), rejects)
