"""User features kept as state between micro-batches.

The state of a user holds, for each feature, the keyword that was the largest as of any time: pairs of time and value in
which both rise, one pair per new maximum.  With it the features as of a cutoff need no history row.  The state is
Spark's own, in a RocksDB store that every executor keeps on disk and saves with the query's checkpoint, so
it outgrows memory, and a restarted query or a lost executor goes on from the last finished batch.

Rows are reduced to such pairs in every task first, so a user with very many rows in a batch sends few of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import event_millis, event_time
from ..operators.history import KEYWORD, TIME, TYPE, USER
from ..schemas import FEATURE_COLUMNS, FEATURE_OF_LOG_TYPE

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FEATURES_DDL = ", ".join(f"{c} string" for c in (USER, *FEATURE_COLUMNS))
# A pair of a feature, or with this number the latest time of a user in the batch.
CUTOFF = -1

Stairs = list[tuple[int, str]]


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of streams that are started from now on in RocksDB, saved as changes to the last state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def stairs(points: Iterable[tuple[int, str]]) -> Stairs:
    """The points at which the maximum rises, in order of time; of one time only the largest value."""
    out: Stairs = []
    for millis, value in sorted(map(tuple, points)):
        if not out or value > out[-1][1]:
            if out and out[-1][0] == millis:
                out.pop()
            out.append((millis, value))
    return out


def as_of(steps: Stairs, cutoff: int) -> str | None:
    """The largest value up to and including a time."""
    return next((value for millis, value in reversed(steps) if millis <= cutoff), None)


def _reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The stairs of each user and feature, and the users' latest times, for all users of a frame at once."""
    for frame in frames:
        if frame.empty:
            continue
        latest = frame[~frame["seed"]].groupby([USER, "seed"], sort=False, as_index=False)["millis"].max()
        parts = [latest.assign(slot=CUTOFF, value=None)]
        for slot, feature in enumerate(FEATURE_COLUMNS):
            some = frame.loc[frame[feature].notna(), [USER, "seed", "millis"]].assign(slot=slot, value=frame[feature])
            if some.empty:
                continue
            # The place of each value among all in order of code points, as in stairs.
            some["order"] = np.unique(some["value"].to_numpy(object), return_inverse=True)[1]
            some = some.sort_values([USER, "seed", "millis", "order"]).drop_duplicates([USER, "seed", "millis"], keep="last")
            highest = some.groupby([USER, "seed"], sort=False)["order"].cummax()
            before = highest.groupby([some[USER], some["seed"]], sort=False).shift(fill_value=-1)
            parts.append(some[some["order"] > before].drop(columns="order"))
        yield pd.concat([p for p in parts if len(p)] or parts)[[USER, "seed", "slot", "millis", "value"]]


def feature_points(rows: DataFrame, seed: bool = False) -> DataFrame:
    """Log rows (user, time, log type, keyword) as pairs of time and value per feature; rows without a valid time or user
    have none.  `seed` marks rows that count as history even for the batch that they come with."""
    own = {f: F.when(F.col(TYPE) == name, F.col(KEYWORD)).otherwise(F.lit("0")) for name, f in FEATURE_OF_LOG_TYPE.items()}
    timed = rows.select(USER, F.lit(seed).alias("seed"), event_millis(event_time(F.col(TIME))).alias("millis"), *[v.alias(f) for f, v in own.items()])
    timed = timed.where(F.col("millis").isNotNull() & F.col(USER).isNotNull())
    return timed.mapInPandas(_reduced, f"{USER} string, seed boolean, slot int, millis bigint, value string")


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known: list[Stairs] = json.loads(state.get[0]) if state.exists else [[] for _ in FEATURE_COLUMNS]
    fresh: list[Stairs] = [[] for _ in FEATURE_COLUMNS]
    cutoff = None
    for frame in frames:
        for seed, slot, millis, value in zip(frame["seed"], frame["slot"].tolist(), frame["millis"].tolist(), frame["value"]):
            if slot == CUTOFF:
                cutoff = millis if cutoff is None else max(cutoff, millis)
            else:
                (known if seed else fresh)[slot].append((millis, value))
    known = [stairs(steps) for steps in known]
    if cutoff is not None:
        yield pd.DataFrame([(key[0], *(as_of(steps, cutoff) for steps in known))], columns=[USER, *FEATURE_COLUMNS])
    state.update((json.dumps([stairs(old + new) for old, new in zip(known, fresh)]),))


def followed_features(points: DataFrame) -> DataFrame:
    """A streaming frame: the features of every user of a batch, as of the user's latest row in it, from all batches before.

    A row counts as history from the batch after its own.  That a later row with the same key replaces it in the
    serving table does not take its keyword back.
    """
    return points.groupBy(USER).applyInPandasWithState(_follow, FEATURES_DDL, "steps string", "append", GroupStateTimeout.NoTimeout)
