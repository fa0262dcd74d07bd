"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.config import EARTH_RADIUS_KM


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Kilometres between two points in degrees; null when a coordinate is missing."""
    half_lat = F.radians(lat_b - lat_a) / 2
    half_lon = F.radians(lon_b - lon_a) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + (
        F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.sin(half_lon) * F.sin(half_lon)
    )
    # Rounding can lift the chord of antipodal points just above 1, where asin is NaN. The null
    # test comes first because least() would skip a null.
    return F.when(
        chord.isNotNull(), F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    )
