"""Shipping corridors: weighted lines of waypoints, from GeoJSON or the built-in table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Id, weight and waypoints (lat, lon) of the built-in corridors.
CORRIDORS = (
    ("strait_of_malacca", 1.4, ((5.5, 97.5), (3.6, 100.3), (2.5, 101.5), (1.6, 103.0), (1.2, 103.8))),
    ("gulf_of_aden_mumbai", 1.2, ((12.5, 43.5), (13.0, 48.0), (14.5, 53.0), (16.5, 60.0), (18.5, 66.0), (19.5, 70.0), (19.0, 72.5))),
    ("strait_of_hormuz", 1.3, ((27.0, 51.5), (26.5, 54.0), (26.0, 56.5), (25.5, 57.5))),
    ("suez_eastern_med", 1.1, ((31.3, 32.3), (30.5, 32.6), (32.5, 33.5), (34.0, 34.5), (35.5, 35.5))),
    ("english_channel_north_sea", 1.2, ((51.2, 1.8), (50.5, 0.0), (50.0, -1.0), (50.1, -4.5), (50.6, -5.5))),
    ("gulf_of_mexico", 1.0, ((26.0, -86.0), (27.2, -88.5), (28.0, -89.0), (27.5, -90.0), (27.8, -92.5))),
    ("bengal_bay_kolkata", 0.9, ((20.5, 86.0), (20.8, 88.5), (21.5, 90.5), (22.3, 91.8))),
    ("south_china_sea", 1.2, ((15.5, 111.0), (12.5, 112.5), (9.5, 114.0), (6.5, 116.5), (4.0, 119.0))),
)
GEOJSON = "features ARRAY<STRUCT<properties: STRUCT<id: STRING, weight: DOUBLE>, geometry: STRUCT<type: STRING, coordinates: ARRAY<ARRAY<DOUBLE>>>>>"


def as_geojson() -> str:
    features = [{"type": "Feature", "properties": {"id": i, "weight": w}, "geometry": {"type": "LineString", "coordinates": [[lon, lat] for lat, lon in p]}} for i, w, p in CORRIDORS]
    return json.dumps({"type": "FeatureCollection", "features": features})


def parse_geojson(texts: DataFrame, column: str = "value") -> DataFrame:
    """idx, id, weight and points (lat, lon) of all lines of two points or more; the weight is 1 where it lacks."""
    f = texts.select(F.posexplode(F.from_json(column, GEOJSON)["features"]).alias("idx", "f"))
    points = F.transform("f.geometry.coordinates", lambda c: F.struct(c[1].alias("lat"), c[0].alias("lon")))
    return f.where((F.col("f.geometry.type") == "LineString") & (F.size("f.geometry.coordinates") >= 2)).select(
        "idx", F.col("f.properties.id").alias("id"), F.coalesce("f.properties.weight", F.lit(1.0)).alias("weight"), points.alias("points")
    )


def corridors(spark: SparkSession, path: str | None = None) -> DataFrame:
    """From a GeoJSON file, or built in."""
    texts = spark.read.text(path, wholetext=True) if path else spark.createDataFrame([(as_geojson(),)], "value string")
    return parse_geojson(texts)


def segments(lines: DataFrame) -> DataFrame:
    """idx, id, weight, seg, and both ends of each segment."""
    pairs = F.zip_with(F.slice("points", 1, F.size("points") - 1), F.slice("points", 2, F.size("points") - 1), lambda a, b: F.struct(a.lat.alias("lat1"), a.lon.alias("lon1"), b.lat.alias("lat2"), b.lon.alias("lon2")))
    return lines.select("idx", "id", "weight", F.posexplode(pairs).alias("seg", "s")).select("idx", "id", "weight", "seg", "s.*")
