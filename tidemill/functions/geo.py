"""Great-circle expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in km between two points given in degrees."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def on_sphere(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Unit vector of a point; chord length grows with great-circle distance."""
    return (
        F.cos(F.radians(lat)) * F.cos(F.radians(lon)),
        F.cos(F.radians(lat)) * F.sin(F.radians(lon)),
        F.sin(F.radians(lat)),
    )
