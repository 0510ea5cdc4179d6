"""Geometry on the mean sphere, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


RADIUS_M = 6371008.8
#: Metres in a degree of latitude.
DEGREE_M = 111195.0802335329


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * RADIUS_M) * F.asin(F.sqrt(a))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in [0, 360); 0 between equal points."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def in_box(lat: Column, lon: Column, box: dict) -> Column:
    """Whether a coordinate is there, is a number, is not zero and lies in the box."""
    fine = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & (lat != 0) & (lon != 0)
    return F.coalesce(fine & lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"]), F.lit(False))
