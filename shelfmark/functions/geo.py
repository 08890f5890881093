"""Distances and grid cells as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The earth's radius, and miles in a degree of latitude and of longitude at the latitudes in use.
EARTH_MILES = 3958.8
MILES_PER_LAT = 69.0
MILES_PER_LNG = 54.6


def haversine_miles(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    # least() passes over nulls, but an unknown place is no distance away.
    return F.when(h.isNotNull(), F.lit(2 * EARTH_MILES) * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def planar_miles(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    return F.sqrt(F.pow((lat1 - lat2) * MILES_PER_LAT, 2) + F.pow((lng1 - lng2) * MILES_PER_LNG, 2))


def cell(lat: Column, lng: Column, size: float = 0.01) -> Column:
    """The grid cell of a point; equal cells are the equi-key of a distance join."""
    return F.concat_ws(":", F.floor(lat / size), F.floor(lng / size))


def in_box(lat: Column, lng: Column, centre: tuple[float, float], miles: float) -> Column:
    """A predicate on bare columns, which reaches the scan; the exact circle comes after it."""
    dlat, dlng = miles / MILES_PER_LAT, miles / (MILES_PER_LNG / 2)
    return lat.between(centre[0] - dlat, centre[0] + dlat) & lng.between(centre[1] - dlng, centre[1] + dlng)
