"""Great-circle expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in km used for all distances.
EARTH_RADIUS_KM = 6372.8


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * (2 * EARTH_RADIUS_KM)


def unit_sphere(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere, so that closeness needs no care at the poles or at ±180°."""
    lat, lon = F.radians(lat), F.radians(lon)
    return F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)
