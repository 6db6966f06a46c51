"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points given in degrees."""
    half_dlat = F.radians(lat2 - lat1) / 2.0
    half_dlon = F.radians(lon2 - lon1) / 2.0
    chord = (
        F.sin(half_dlat) * F.sin(half_dlat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_dlon) * F.sin(half_dlon)
    )
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))
