"""Dictionary joins of the bid log.

No join here carries a broadcast hint.  Spark compares each dictionary's size with
spark.sql.autoBroadcastJoinThreshold (and again at run time, from shuffle sizes) and broadcasts below it;
above it both sides are shuffled and adaptive execution splits the hot partitions of the log side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import keyword_or_tags, tag_key


@dataclass(frozen=True)
class Dictionaries:
    """The lookup tables of the enrichment jobs."""

    ad_exchange: DataFrame
    log_type: DataFrame
    city: DataFrame
    state: DataFrame
    keyword: DataFrame


def keyword_dictionary(site_pages: DataFrame, profile_tags: DataFrame) -> DataFrame:
    """Both keyword sources under one id and name; an id in both stays there twice."""
    pages = site_pages.select(F.col("site_page_id").alias("keyword_id"), F.col("site_page_tag").alias("keyword_name"))
    tags = profile_tags.select(
        F.col("user_profile_tag_id").alias("keyword_id"), F.col("user_profile_tag_value").alias("keyword_name")
    )
    return pages.union(tags)


def join_exchange(log: DataFrame, ad_exchange: DataFrame) -> DataFrame:
    return log.join(ad_exchange, "ad_exchange_id", "left")


def join_log_type(log: DataFrame, log_type: DataFrame) -> DataFrame:
    return log.join(log_type, "log_type_id", "left")


def join_city(log: DataFrame, city: DataFrame) -> DataFrame:
    """Inner, so that every row that goes on has a place."""
    return log.join(city, "city_id", "inner")


def join_state(log: DataFrame, state: DataFrame) -> DataFrame:
    """State of the city, after join_city.

    City and state are not joined to each other first: Spark estimates a join as the product of its sides, and
    would take the result for too large to broadcast.
    """
    return log.join(state, "state_id", "left")


def join_keyword(log: DataFrame, keyword: DataFrame) -> DataFrame:
    """Left join of the tag text to the keyword id; keyword_name falls back to the tag text.

    Lists of tags and missing tags have no key.  Where both sides are shuffled, such rows are dealt out by a hash of
    the row instead of meeting in one task; the second condition keeps that hash from matching anything.
    """
    key = tag_key(log["user_tags"])
    dealt_by = F.coalesce(key, F.xxhash64(*[log[c] for c in log.columns[:3]]))
    matched = log.join(keyword, (dealt_by == keyword["keyword_id"]) & key.isNotNull(), "left")
    return matched.select(
        *[log[c] for c in log.columns],
        keyword_or_tags(keyword["keyword_name"], log["user_tags"]).alias("keyword_name"),
    )
