"""Distances between points, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6372.8  # fixed value


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in km of points in degrees; null if a coordinate is."""
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), F.lit(2)) + F.pow(F.sin(dlng / 2), F.lit(2)) * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def euclidean(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, F.lit(2)) + F.pow(y1 - y2, F.lit(2)))
