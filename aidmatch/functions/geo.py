"""Coordinates and great-circle distance as native column expressions."""

from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371  # fixed value

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def haversine(a, b):
    """Kilometres between two positions made by :func:`position` (structs or struct columns)."""
    half = F.pow(F.sin((b["rlat"] - a["rlat"]) / 2), 2) + a["clat"] * b["clat"] * F.pow(
        F.sin((b["rlon"] - a["rlon"]) / 2), 2
    )
    # Rounding can push the term just above 1, where the square root is NaN.
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(half), F.sqrt(F.greatest(F.lit(0.0), 1 - half)))


def position(lat, lon):
    """Radians and latitude cosine of a point, computed once per record."""
    return F.struct(
        F.radians(lat).alias("rlat"),
        F.radians(lon).alias("rlon"),
        F.cos(F.radians(lat)).alias("clat"),
    )


def haversine_km(lat_a, lon_a, lat_b, lon_b):
    return haversine(position(lat_a, lon_a), position(lat_b, lon_b))


def may_reach(a, b, radius_km):
    """Cheap exact prefilter: a distance is never below its latitude difference."""
    return F.abs(a["rlat"] - b["rlat"]) * EARTH_RADIUS_KM <= radius_km + 1e-6


def parse_coordinates(text):
    """``"lat,lon"`` to a struct of two doubles, null unless it holds exactly two numbers."""
    parts = F.split(text, ",", -1)

    def number(i):
        part = F.trim(F.get(parts, F.lit(i)), F.lit(" \t\r\n"))
        return F.when(part.rlike(_NUMBER), part.try_cast("double"))

    lat, lon = number(0), number(1)
    return F.when(
        (F.size(parts) == 2) & lat.isNotNull() & lon.isNotNull(),
        F.struct(lat.alias("lat"), lon.alias("lon")),
    )


def format_coordinates(lat, lon):
    return F.concat_ws(",", F.round(lat, 6).cast("string"), F.round(lon, 6).cast("string"))
