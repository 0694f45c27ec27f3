import math
import random

import pytest
from pyspark.sql import functions as F

from bidtrail.operators import geo


def km(a, b):
    (lat1, lon1), (lat2, lon2) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("radius", [5.0, 300.0, 4000.0, 25000.0])
def test_radius_join_equals_all_pairs(spark, radius):
    rng = random.Random(int(radius))
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    points += [(200, 90.0, 0.0), (201, -90.0, 10.0), (202, 0.0, 180.0), (203, 0.0, -180.0), (204, 89.99, 170.0), (205, None, 1.0), (206, 1.0, None)]
    points += [(300 + i, 48.0 + rng.uniform(-0.1, 0.1), 11.0 + rng.uniform(-0.1, 0.1)) for i in range(60)]
    centres = [(i, lat, lon) for i, lat, lon in rng.sample(points, 40)] + [(900, 48.0, 11.0), (901, 0.0, 179.99), (902, 89.9, -10.0), (903, None, None)]
    left = spark.createDataFrame(points, "id int, lat double, lon double").repartition(4)
    right = spark.createDataFrame(centres, "c_id int, c_lat double, c_lon double")
    found = geo.within_radius(left, right, radius, ("lat", "lon"), ("c_lat", "c_lon"))
    got = sorted((r["id"], r["c_id"]) for r in found.collect())
    valid = lambda rows: [(i, (a, b)) for i, a, b in rows if a is not None and b is not None]
    assert got == sorted((i, j) for i, p in valid(points) for j, c in valid(centres) if km(p, c) <= radius)


def test_no_cross_join(spark):
    left = spark.createDataFrame([(1, 1.0, 1.0)], "id int, lat double, lon double")
    found = geo.within_radius(left, left.toDF("b", "b_lat", "b_lon"), 10, ("lat", "lon"), ("b_lat", "b_lon"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_cells_follow_the_curve(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (-90.0, 179.9), (90.0, -180.0), (89.9, 179.9), (0.0, 180.0)], "lat double, lon double")
    cells = [r[0] for r in df.select(geo.cell_of(F.col("lat"), F.col("lon"), 2)).collect()]
    assert cells == [0, 0b0101, 0b1010, 0b1111, 0b1000]
