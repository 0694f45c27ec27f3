"""Word counts and searchable terms."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import split_text
from ..functions.stemming import stem, stem_of

# The public list of English stop words used by text-search indexes.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these "
    "they this to was will with"
).split()


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each space-separated word."""
    words = lines.where(F.col(column).isNotNull()).select(F.explode(split_text(F.col(column), " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def index_terms(df: DataFrame, column: str) -> DataFrame:
    """One row per term of a text column: lower case, letters and digits only, stop words left out; not stemmed."""
    words = F.split(F.lower(F.col(column)), r"[^\p{L}\p{N}]+")
    return df.select("*", F.explode(words).alias("term")).where(
        (F.col("term") != "") & ~F.col("term").isin(ENGLISH_STOP_WORDS)
    )


def token_positions(df: DataFrame, column: str) -> DataFrame:
    """Term and position (from 1) of every word of a text column; stop words are left out, but count as positions."""
    words = F.filter(F.split(F.lower(F.col(column)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    placed = df.select("*", F.posexplode(words).alias("_at", "term"))
    return placed.where(~F.col("term").isin(ENGLISH_STOP_WORDS)).withColumn("position", F.col("_at") + 1).drop("_at")


def analysed_terms(df: DataFrame, column: str) -> DataFrame:
    """token_positions with the stem of each term; every distinct term is stemmed once and joined back."""
    tokens = token_positions(df, column)
    stems = tokens.select("term").distinct().withColumn("stem", stem_of("term"))
    return tokens.join(stems, "term")


def rows_matching(analysed: DataFrame, key: str, query: str) -> DataFrame:
    """Keys of the texts that hold every word of a query, in any inflection, with the number of places where one stands."""
    wanted = sorted({stem(w) for w in re.split(r"[\W_]+", query.lower()) if w and w not in ENGLISH_STOP_WORDS})
    found = analysed.where(F.col("stem").isin(wanted)).groupBy(key).agg(F.count_distinct("stem").alias("_words"), F.count("*").alias("places"))
    return found.where((F.col("_words") == len(wanted)) & F.lit(bool(wanted))).drop("_words")
