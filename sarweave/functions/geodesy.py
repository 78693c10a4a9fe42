"""Column functions on positions: distances, bearings, offsets, frames, corners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEGREE = 111.32
EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    d = F.radians(lon2 - lon1)
    x = F.sin(d) * F.cos(F.radians(lat2))
    y = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(x, y)) + 360, F.lit(360.0))


def angle_between(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, 360 - d)


def foot(lat: Column, lon: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> tuple[Column, Column]:
    """The place (lat, lon) of a segment that is nearest to a point, in the flat frame around the point."""
    east = F.cos(F.radians(lat))
    dx, dy = (lon2 - lon1) * east, lat2 - lat1
    t = ((lon - lon1) * east * dx + (lat - lat1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))
    return lat1 + t * (lat2 - lat1), lon1 + t * (lon2 - lon1)


def segment_km(lat: Column, lon: Column, lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance of a point to a segment in the flat frame around the point."""
    east = KM_PER_DEGREE * F.cos(F.radians(lat))
    ax, ay = (lon1 - lon) * east, (lat1 - lat) * KM_PER_DEGREE
    dx, dy = (lon2 - lon1) * east, (lat2 - lat1) * KM_PER_DEGREE
    length = dx * dx + dy * dy
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(-(ax * dx + ay * dy) / F.nullif(length, F.lit(0.0)), F.lit(0.0))))
    return F.sqrt(F.pow(ax + t * dx, F.lit(2)) + F.pow(ay + t * dy, F.lit(2)))


def perpendicular(dlat: Column, dlon: Column, lat: Column, offset: Column, side: Column) -> tuple[Column, Column]:
    """Degrees of latitude and longitude of an offset (in degrees of latitude) to the left (side 1) or right (-1) of a heading.

    The heading is turned in a frame of equal east and north units; a heading of no length counts as eastbound.
    """
    c = F.cos(F.radians(lat))
    still = (F.abs(dlon * c) < 1e-12) & (F.abs(dlat) < 1e-12)
    east, north = F.when(still, 1.0).otherwise(dlon * c), F.when(still, 0.0).otherwise(dlat)
    n = F.sqrt(east * east + north * north)
    return offset * (east * side) / n, offset * (-north * side) / n / F.greatest(c, F.lit(1e-6))


def frame(lat: Column, lon: Column, w: Column, h: Column, pixel_m: float = 10.0) -> Column:
    """A north-up frame of w x h pixels around a centre: origin and degrees per pixel."""
    metres = KM_PER_DEGREE * 1000
    dlat = F.lit(pixel_m / metres)
    dlon = F.lit(pixel_m) / (metres * F.greatest(F.cos(F.radians(lat)), F.lit(1e-6)))
    return F.struct((lat + h / 2 * dlat).alias("lat0"), (lon - w / 2 * dlon).alias("lon0"), dlat.alias("dlat"), dlon.alias("dlon"))


def corners(f: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """Corners of a window clockwise from the top left, as (lon, lat) of six places."""
    top, left = f["lat0"] - y * f["dlat"], f["lon0"] + x * f["dlon"]
    low, right = top - h * f["dlat"], left + w * f["dlon"]
    point = lambda a, b: F.struct(F.bround(a, 6).alias("lon"), F.bround(b, 6).alias("lat"))
    return F.array(point(left, top), point(right, top), point(right, low), point(left, low))


def affine(t: Column, col: Column, row: Column) -> tuple[Column, Column]:
    """x and y of a pixel by six coefficients a..f."""
    return t[2] + t[0] * col + t[1] * row, t[5] + t[3] * col + t[4] * row


def is_georeferenced(crs: Column, t: Column) -> Column:
    return crs.isNotNull() & (crs != "") & ~((t[0] == 1) & (t[1] == 0) & (t[2] == 0) & (t[3] == 0) & (t[4] == 1) & (t[5] == 0))


def format_corners(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda p: F.concat(F.lit("("), p["lon"].cast("string"), F.lit(", "), p["lat"].cast("string"), F.lit(")"))), ", "), F.lit("]"))


def parse_corners(s: Column) -> Column:
    """An array of (lon, lat) from the text form, exponents included."""
    number = r"-?[0-9]+(?:\.[0-9]*)?(?:[eE][-+]?[0-9]+)?"
    lon, lat = (F.regexp_extract_all(s, F.lit(rf"\(\s*({number})\s*,\s*({number})\s*\)"), F.lit(k)) for k in (1, 2))
    return F.zip_with(lon, lat, lambda a, b: F.struct(a.try_cast("double").alias("lon"), b.try_cast("double").alias("lat")))


def at_sea(lat: Column, lon: Column) -> Column:
    """Without a land mask every position on the map may be at sea."""
    return (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


