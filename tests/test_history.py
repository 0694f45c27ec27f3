import random

import pytest
from pyspark.sql import functions as F

from bidtrail.operators import history as hist
from bidtrail.operators import joins
from bidtrail.schemas import FEATURE_COLUMNS, FEATURE_OF_LOG_TYPE

DDL = "bid_id string, ipinyou_id string, timestamp string, log_type_name string, keyword_name string"
KINDS = [*FEATURE_OF_LOG_TYPE, "other", None]


def stamp(hour, milli=0):
    return f"201306{6 + hour // 24:02d}{hour % 24:02d}0000{milli:03d}"


def random_events(seed, n=300, users=4):
    rng = random.Random(seed)
    events = []
    for i in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(users)}"
        time = rng.choice([stamp(rng.randrange(60), rng.randrange(3)), "null", ""]) if rng.random() < 0.05 else stamp(rng.randrange(60), rng.randrange(3))
        events.append((str(i), user, time, rng.choice(KINDS), rng.choice(["a", "b", "c", "10", "9", None])))
    return events


def brute_features(rows):
    """Largest keyword per type over some history rows, plainly."""
    result = []
    for kind in FEATURE_OF_LOG_TYPE:
        values = [r[4] if r[3] == kind else "0" for r in rows]
        known = [v for v in values if v is not None]
        result.append(max(known) if known else None)
    return tuple(result)


def valid(time):
    return time is not None and len(time) == 17 and time.isdigit()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_features_equal_brute_force(spark, seed):
    history, batch = random_events(seed), random_events(seed + 100, 40, users=6)
    frames = [spark.createDataFrame(x, DDL) for x in (history, batch)]
    got = {r["bid_id"]: tuple(r[f] for f in FEATURE_COLUMNS) for r in hist.attach_features(frames[1], hist.user_features(*frames), ["bid_id"]).collect()}
    expected = {}
    for row in batch:
        # Every batch row of a user sees the history up to the user's latest batch row.
        times = [b[2] for b in batch if b[1] == row[1] and valid(b[2])]
        seen = [h for h in history if h[1] == row[1] and valid(h[2]) and times and h[2] <= max(times)]
        expected[row[0]] = brute_features(seen) if seen else (None,) * 5
    assert got == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_large_side_path_is_equal(spark, rows, seed, monkeypatch):
    frames = [spark.createDataFrame(x, DDL) for x in (random_events(seed), random_events(seed + 50, 60))]
    expected = rows(hist.user_features(*frames)), rows(hist.reduce_history(*frames))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins, "PART_ROWS", 5)
    assert (rows(hist.user_features(*frames)), rows(hist.reduce_history(*frames).select(*frames[0].columns))) == (expected[0], rows(frames[0].join(frames[1], "ipinyou_id", "left_semi").select(*frames[0].columns)))
    assert len(expected[1]) > 0


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("unit", ["HOUR", "DAY", "MINUTE"])
def test_asof_equals_brute_force(spark, seed, unit):
    events = random_events(seed)
    frame = spark.createDataFrame(events, DDL)
    got = {r["bid_id"]: tuple(r[f] for f in FEATURE_COLUMNS) for r in hist.keyword_asof(frame, unit).collect()}
    expected = {}
    for row in events:
        seen = [h for h in events if h[1] == row[1] and valid(h[2]) and valid(row[2]) and h[2] <= row[2]]
        expected[row[0]] = brute_features(seen) if seen else (None,) * 5
    assert got == expected


def one(spark, history, batch):
    frames = [spark.createDataFrame(x, DDL) for x in (history, batch)]
    return [tuple(r) for r in hist.attach_features(frames[1], hist.user_features(*frames), ["bid_id"]).select("bid_id", *FEATURE_COLUMNS).orderBy("bid_id").collect()]


def test_three_outcomes(spark):
    history = [("h1", "u", stamp(1), "bid-click", "shoes"), ("h2", "u", stamp(1), "bid-click", "boots"), ("h3", "v", stamp(1), "site-open", None)]
    batch = [("b1", "u", stamp(2), None, None), ("b2", "v", stamp(2), None, None), ("b3", "w", stamp(2), None, None)]
    assert one(spark, history, batch) == [
        ("b1", "shoes", "0", "0", "0", "0"),
        ("b2", "0", None, "0", "0", "0"),
        ("b3", None, None, None, None, None),
    ]


def test_rows_of_a_user_share_the_later_features(spark):
    history = [("h1", "u", stamp(5), "bid-click", "late")]
    batch = [("b1", "u", stamp(2), None, None), ("b2", "u", stamp(8), None, None)]
    assert {r[1] for r in one(spark, history, batch)} == {"late"}
    asof = hist.keyword_asof(spark.createDataFrame(history + batch, DDL)).where(F.col("bid_id") == "b1").first()
    assert asof["bid_click_kw"] == "0"  # only the event itself is that old


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_asof_collects_no_lists(spark):
    plan = plan_of(hist.keyword_asof(spark.createDataFrame(random_events(1), DDL)))
    assert "collect_list" not in plan and "CartesianProduct" not in plan


def test_pivot_counts_before_it_sorts(spark):
    """No sort stands between the history rows and the first shuffle."""
    frames = [spark.createDataFrame(x, DDL) for x in (random_events(1), random_events(2, 40))]
    steps = [line for line in plan_of(hist.user_features(*frames)).splitlines() if "Sort" in line or "Exchange hashpartitioning" in line or "partial_count" in line]
    first_count = max(i for i, line in enumerate(steps) if "partial_count" in line)
    assert all("Sort [" not in line for line in steps[first_count:])
