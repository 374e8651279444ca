"""Column expressions for distances and the scores built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetloom.fixed_values import EARTH_RADIUS_M


def haversine_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance in metres; coordinates in degrees."""
    half_lat = F.sin((F.radians(lat_b) - F.radians(lat_a)) / 2)
    half_lon = F.sin((F.radians(lon_b) - F.radians(lon_a)) / 2)
    inner = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(F.lit(1.0), inner))) * (2 * EARTH_RADIUS_M)


def proximity_score(distance_m: Column, radius_m: float) -> Column:
    """1 at the same place, 0 at the radius and beyond."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - distance_m / float(radius_m)))


def hybrid_score(proximity: Column, affinity: Column, geo_weight: float, cat_weight: float) -> Column:
    return proximity * float(geo_weight) + affinity * float(cat_weight)


def within_bounds(lat: Column, lon: Column, lat_bounds: tuple, lon_bounds: tuple) -> Column:
    """True only for present coordinates in the world range and in the (inclusive) box."""
    world = lat.between(-90, 90) & lon.between(-180, 180)
    box = lat.between(*lat_bounds) & lon.between(*lon_bounds)
    present = ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(present & world & box, F.lit(False))
