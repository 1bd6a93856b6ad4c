"""Spherical measures as column expressions; coordinates in degrees. Planar geometry is in ``spatial``."""

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean earth radius in metres: fixed value.
EARTH = 6371008.8


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    half = lambda x: F.pow(F.sin(F.radians(x) / 2), F.lit(2.0))
    return 2 * EARTH * F.asin(F.sqrt(half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon2 - lon1)))


def azimuth(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Direction from the first point in degrees, clockwise from north, on the local plane of the first point."""
    return (F.degrees(F.atan2((lon2 - lon1) * F.cos(F.radians(lat1)), lat2 - lat1)) + 360) % 360


def in_polygon(x: Column, y: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Whether a point lies in a fixed ring, by crossings of a ray; stays in generated code."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if y1 != y2:
            hit = ((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
            crossings = crossings + hit.cast("int")
    return crossings % 2 == 1


def translate_metres(x: Column, y: Column, east: Column, north: Column) -> tuple[Column, Column]:
    """Point shifted by metres on the local plane."""
    per_degree = math.pi / 180 * EARTH
    return x + east / (per_degree * F.cos(F.radians(y))), y + north / per_degree
