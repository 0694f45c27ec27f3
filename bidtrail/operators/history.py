"""Keyword features of a user from the user's own earlier events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import event_time
from ..schemas import FEATURE_COLUMNS, FEATURE_OF_LOG_TYPE
from ..session import stored
from .joins import Hold, keyed_join

USER, TIME, TYPE, KEYWORD = "ipinyou_id", "timestamp", "log_type_name", "keyword_name"
HISTORY_DDL = f"{USER} string, {TIME} string, {TYPE} string, {KEYWORD} string"
HIST_TYPE, HIST_KEYWORD = "hist_log_type_name", "hist_keyword_name"


def _spread(history: DataFrame) -> list[str]:
    """Columns that tell the rows of one user apart."""
    return [c for c in ("bid_id", TIME, TYPE, KEYWORD) if c in history.columns]


def reduce_history(history: DataFrame, batch: DataFrame, hold: Hold = stored) -> DataFrame:
    """History rows of the users that occur in the batch."""
    return keyed_join(history, batch.select(USER).distinct(), USER, _spread(history), "left_semi", hold)


def user_cutoffs(batch: DataFrame) -> DataFrame:
    """Latest event time of each user in the batch: all a batch contributes to its users' features."""
    cutoffs = batch.groupBy(USER).agg(F.max(event_time(F.col(TIME))).alias("cutoff"))
    return cutoffs.where(F.col("cutoff").isNotNull())


def rows_until_cutoff(history: DataFrame, batch: DataFrame, hold: Hold = stored) -> DataFrame:
    """History rows at or before their user's latest event in the batch; rows without a valid time are left out.

    The batch is reduced to one row per user first, so that the result is at most as long as the history:
    pairing every batch row with every earlier row gives the same features from many times the rows.
    """
    rows = keyed_join(history, user_cutoffs(batch), USER, _spread(history), "inner", hold)
    return rows.where(F.col("cutoff") >= event_time(F.col(TIME))).drop("cutoff")


def as_past(rows: DataFrame) -> DataFrame:
    """History columns under the names the feature query reads."""
    return rows.select(
        USER,
        F.col(TIME).alias("hist_timestamp"),
        F.col(KEYWORD).alias(HIST_KEYWORD),
        F.col(TYPE).alias(HIST_TYPE),
    )


def history_until_cutoff(history: DataFrame, batch: DataFrame, hold: Hold = stored) -> DataFrame:
    """The history of the batch's users, one row per history row that counts."""
    return as_past(rows_until_cutoff(history, batch, hold))


def _largest_keywords() -> list[Column]:
    """Per feature: the largest keyword of its log type, where rows of other types count as '0'."""
    return [
        F.max(F.when(F.col(HIST_TYPE) == name, F.col(HIST_KEYWORD)).otherwise(F.lit("0"))).alias(feature)
        for name, feature in FEATURE_OF_LOG_TYPE.items()
    ]


def keyword_pivot(rows: DataFrame) -> DataFrame:
    """Largest keyword per user and log type, one column per type.

    Null: no such row has a keyword; '0': the user has rows, none of this type.  The rows are first counted per
    user, type and keyword, by hashing in each task before the shuffle, so only distinct keywords are sorted.  (A plain
    distinct would not do: Spark removes it below a maximum, and then sorts every row.)
    """
    counted = rows.groupBy(USER, HIST_TYPE, HIST_KEYWORD).agg(F.count("*").alias("_n")).where("_n > 0")
    return counted.groupBy(USER).agg(*_largest_keywords())


def user_features(history: DataFrame, batch: DataFrame, hold: Hold = stored) -> DataFrame:
    """Features of every batch user that has history, one row per user."""
    return keyword_pivot(history_until_cutoff(history, batch, hold))


def attach_features(batch: DataFrame, features: DataFrame, spread: list[str], hold: Hold = stored) -> DataFrame:
    """Batch rows with their user's features; nulls for users without history."""
    return keyed_join(batch, features, USER, spread, "left", hold)


def with_no_features(rows: DataFrame) -> DataFrame:
    """The same rows with empty features, as stored for users without history."""
    return rows.withColumns({feature: F.lit(None).cast("string") for feature in FEATURE_COLUMNS})


def keyword_asof(events: DataFrame, slice_unit: str = "MINUTE") -> DataFrame:
    """Features of every event as of its own time: history up to and including that time.

    A running maximum over all of a user's rows would put the user into one task.  So a user's time line is cut into
    slices: a running maximum inside each slice, and before it the maximum over the user's earlier slices, of which
    there is one row each.  No task holds more than the events of one user and slice.  Rows without a valid time
    count for nothing and get no features.
    """
    time = event_time(F.col(TIME))
    own = {f: F.when(F.col(TYPE) == name, F.col(KEYWORD)).otherwise(F.lit("0")) for name, f in FEATURE_OF_LOG_TYPE.items()}
    timed = events.withColumn("_time", time).withColumn("_slice", F.date_trunc(slice_unit, "_time"))
    timed = timed.withColumns({f"_own_{f}": F.when(F.col("_time").isNotNull(), value) for f, value in own.items()})
    within = Window.partitionBy(USER, "_slice").orderBy("_time").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = timed.withColumns({f"_now_{f}": F.max(f"_own_{f}").over(within) for f in FEATURE_COLUMNS})

    slices = timed.where("_time IS NOT NULL").groupBy(USER, "_slice").agg(*[F.max(f"_own_{f}").alias(f"_all_{f}") for f in FEATURE_COLUMNS])
    earlier = Window.partitionBy(USER).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.select(USER, "_slice", *[F.max(f"_all_{f}").over(earlier).alias(f"_before_{f}") for f in FEATURE_COLUMNS])
    found = running.join(before, [USER, "_slice"], "left")
    return found.select(*events.columns, *[F.greatest(f"_now_{f}", f"_before_{f}").alias(f) for f in FEATURE_COLUMNS])
