"""Points in cells of a grid, and joins by distance without comparing all pairs.

A cell is a square of the latitude-longitude grid at a level of 2^level rows and columns, numbered along a Z-shaped
space-filling curve, so that near cells have near numbers and a table sorted by cell can be skipped through.
A radius join meets points and centres in the cells that the circle may touch and then measures the distance.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .joins import Hold, keyed_join

EARTH_KM = 6371.0088
MOST_LEVEL = 30
# A little wider than the circle, for what rounding may take off its box.
MARGIN = 1e-6


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points in degrees, by the haversine formula."""
    half = lambda a, b: F.sin(F.radians(b - a) / 2)
    chord = half(lat1, lat2) * half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2) * half(lon1, lon2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def _row(lat: Column, level: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit((1 << level) - 1), F.floor((lat + 90) / 180 * (1 << level)))).cast("bigint")


def _column(lon: Column, level: int) -> Column:
    """Column before it is taken around the globe."""
    return F.floor((lon + 180) / 360 * (1 << level)).cast("bigint")


def _curve(row: Column, column: Column, level: int) -> Column:
    """Bits of row and column in turns, spread by doubling the gaps."""
    def spread(n: Column) -> Column:
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            n = n.bitwiseOR(F.shiftleft(n, shift)).bitwiseAND(F.lit(mask))
        return n

    return spread(F.pmod(column, F.lit(1 << level))).bitwiseOR(F.shiftleft(spread(row), 1))


def cell_of(lat: Column, lon: Column, level: int) -> Column:
    """Number of the cell of a point; null without a point."""
    return F.when(lat.isNotNull() & lon.isNotNull(), _curve(_row(lat, level), _column(lon, level), level))


def level_for(radius_km: float) -> int:
    """The finest level whose rows are at least as high as the radius."""
    return max(0, min(MOST_LEVEL, int(math.floor(math.log2(math.pi * EARTH_KM / radius_km)))))


def cells_around(lat: Column, lon: Column, radius_km: float, level: int) -> Column:
    """Numbers of all cells that a circle around a point may touch: its own and neighbours, also beyond the date line."""
    high = F.lit(math.degrees(radius_km / EARTH_KM) + MARGIN)
    most = F.least(F.abs(lat) + high, F.lit(90.0))
    # Of a circle that holds a pole the box goes around the globe.
    ratio = F.sin(F.lit(min(radius_km / EARTH_KM, math.pi / 2))) / F.cos(F.radians(lat))
    wide = F.when(most >= 90, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))) + MARGIN)
    rows = F.sequence(_row(lat - high, level), _row(lat + high, level))
    first = _column(lon - wide, level)
    columns = F.sequence(first, F.least(_column(lon + wide, level), first + (1 << level) - 1))
    cells = F.flatten(F.transform(rows, lambda r: F.transform(columns, lambda c: _curve(r, c, level))))
    return F.when(lat.isNotNull() & lon.isNotNull(), cells)


def within_radius(points: DataFrame, centres: DataFrame, radius_km: float, point: tuple[str, str], centre: tuple[str, str], hold: Hold = stored) -> DataFrame:
    """Rows of points and centres (with different column names) at most radius_km apart, with distance_km.

    point and centre name the columns of latitude and longitude.  Rows without a point match nothing.  The cells of the
    centres are broadcast only if they measure small; else crowded cells of points are split over many tasks.
    """
    level = level_for(radius_km)
    dealt = points.withColumn("_cell", cell_of(*map(F.col, point), level)).where("_cell IS NOT NULL")
    touched = centres.withColumn("_cell", F.explode(cells_around(*map(F.col, centre), radius_km, level)))
    met = keyed_join(dealt, touched, "_cell", list(points.columns), "inner", hold).drop("_cell")
    return met.withColumn("distance_km", distance_km(*map(F.col, (*point, *centre)))).where(F.col("distance_km") <= radius_km)
