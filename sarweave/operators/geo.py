"""Geospatial operators: nearest corridor, synthetic locations, vessel tracks, drift."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sarweave.functions import geodesy as G
from sarweave.functions import scalars as S
from sarweave.operators import kernels

MAX_SEGMENTS = 10_000


def _segments_array(segs: DataFrame, fields: list[str]) -> Column:
    """All segments as one literal array. They are a reference table; a larger one than MAX_SEGMENTS is refused."""
    rows = segs.select(*fields).limit(MAX_SEGMENTS + 1).collect()
    if len(rows) > MAX_SEGMENTS:
        raise ValueError(f"more than {MAX_SEGMENTS} segments: cut the points into regions and join each with its own")
    return F.array(*(F.struct(*(F.lit(r[f]).alias(f) for f in fields)) for r in rows))


def nearest_segment(points: DataFrame, segs: DataFrame) -> DataFrame:
    """points (lat, lon) with near: km, id, seg, and the bearing of the nearest segment. Row by row, without a join."""
    fields = ["id", "seg", "lat1", "lon1", "lat2", "lon2"]
    lat, lon = F.col("lat"), F.col("lon")
    each = F.transform(
        _segments_array(segs, fields),
        lambda s: F.struct(
            G.segment_km(lat, lon, s.lat1, s.lon1, s.lat2, s.lon2).alias("km"), s.id.alias("id"), s.seg.alias("seg"),
            G.bearing(s.lat1, s.lon1, s.lat2, s.lon2).alias("bearing"),
        ),
    )
    return points.withColumn("near", F.array_min(each))


def weighted_pick(lines: DataFrame) -> DataFrame:
    """lines with low and high, the part of [0, 1) that picks each by weight. The table is small: one row per line."""
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("weight").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return lines.withColumn("high", F.sum("weight").over(upto) / total).withColumn("low", F.col("high") - F.col("weight") / total)


def synthetic_locations(rows: DataFrame, key: str, lines: DataFrame, scale_km: float = 50.0, seed: int = 42) -> DataFrame:
    """rows with corridor, lat, lon and offset_km: a weighted corridor, a segment and a place on it, and a half-normal offset to one side, by keyed hashes."""
    k = F.col(key)
    u = {name: S.unit(k, seed, name) for name in ("pick", "seg", "t", "r", "a", "side")}
    picks = weighted_pick(lines)
    rows_of = picks.select("id", "low", "high", "points").collect()
    table = F.array(*(F.struct(F.lit(r.id).alias("id"), F.lit(r.low).alias("low"), F.lit(r.high).alias("high"), F.array(*(F.struct(F.lit(p.lat).alias("lat"), F.lit(p.lon).alias("lon")) for p in r.points)).alias("points")) for r in rows_of))
    chosen = F.coalesce(F.get(F.filter(table, lambda c: (u["pick"] >= c.low) & (u["pick"] < c.high)), F.lit(0)), F.element_at(table, -1))
    out = rows.withColumn("_c", chosen).withColumn("_n", F.floor(u["seg"] * (F.size("_c.points") - 1)).cast("int"))
    a, b = F.get("_c.points", F.col("_n")), F.get("_c.points", F.col("_n") + 1)
    out = out.withColumns({"_a": a, "_b": b})
    dlat, dlon = F.col("_b.lat") - F.col("_a.lat"), F.col("_b.lon") - F.col("_a.lon")
    normal = F.abs(F.sqrt(-2 * F.log(1 - u["r"])) * F.cos(2 * np.pi * u["a"]))
    km = normal * scale_km
    side = F.when(u["side"] < 0.5, 1.0).otherwise(-1.0)
    lat = F.col("_a.lat") + u["t"] * dlat
    olat, olon = G.perpendicular(dlat, dlon, lat, km / G.KM_PER_DEGREE, side)
    lon = F.col("_a.lon") + u["t"] * dlon + olon
    return out.select(*rows.columns, F.col("_c.id").alias("corridor"), F.col("_n").alias("seg"), (lat + olat).alias("lat"), (F.pmod(lon + 180, F.lit(360.0)) - 180).alias("lon"), km.alias("offset_km"))


def measured(segs: DataFrame) -> DataFrame:
    """Segments with their length and the length of their line before them."""
    before = Window.partitionBy("idx").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    s = segs.withColumn("km", G.haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))
    return s.withColumn("km0", F.coalesce(F.sum("km").over(before), F.lit(0.0)))


def vessel_tracks(spark: SparkSession, lines: DataFrame, segs: DataFrame, vessels: int, steps: int, minutes: int = 10) -> DataFrame:
    """Regular positions of vessels that go along corridors, dealt in turn: mmsi, step, lat, lon, heading, speed_knots.

    Distance is speed times steps, wrapped at the end of the line; the segment is found by its range
    of distance within the vessel's own corridor.
    """
    n = lines.count()
    speed = F.greatest(F.lit(5.0), F.least(F.lit(25.0), 8 + 12 * S.unit(F.col("v"), "speed")))
    v = spark.range(vessels).select(F.col("id").alias("v"), (F.col("id") % n).cast("int").alias("idx"))
    v = v.withColumn("speed_knots", speed)
    total = measured(segs).groupBy("idx").agg(F.sum("km").alias("total"))
    at = v.join(F.broadcast(total), "idx").select("*", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
    at = at.withColumn("s", F.pmod(F.col("step") * F.col("speed_knots") * 1.852 * minutes / 60, F.col("total")))
    m = F.broadcast(measured(segs).select("idx", "km", "km0", "lat1", "lon1", "lat2", "lon2"))
    on = at.join(m, "idx").where((F.col("s") >= F.col("km0")) & (F.col("s") < F.col("km0") + F.col("km")))
    t = (F.col("s") - F.col("km0")) / F.col("km")
    return on.select(
        (F.lit(200_000_000) + F.col("v")).alias("mmsi"), "step", (F.col("lat1") + t * (F.col("lat2") - F.col("lat1"))).alias("lat"),
        (F.col("lon1") + t * (F.col("lon2") - F.col("lon1"))).alias("lon"),
        G.bearing(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")).alias("heading"), "speed_knots",
    )


def hull_polygon(points: np.ndarray, half: float = 0.0005) -> list[list[float]] | None:
    """A closed ring around points; a small square for fewer than three, None where they lie on one line."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        if not len(p):
            return None
        y, x = p.mean(axis=0)
        ring = [(y - half, x - half), (y - half, x + half), (y + half, x + half), (y + half, x - half)]
    else:
        ring = kernels.hull(p).tolist()
        if len(ring) < 3:
            return None
    return [list(map(float, q)) for q in [*ring, ring[0]]]


DRIFT = "pair int, release_type string, initial_shape array<array<double>>, resulting_shape array<array<double>>, elapsed_hours double, backend string"


def drift_pairs(spark: SparkSession, n: int, hours: float = 24.0, minutes: int = 30, seed: int = 42) -> DataFrame:
    """Slicks before and after a drift: particles of a point or line release, moved by current, three hundredths of the wind and a random walk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i in b["id"]:
                rng = np.random.default_rng([seed, int(i)])
                point = rng.random() < 0.6
                lat, lon = rng.uniform(5, 30), rng.uniform(45, 95)
                if point:
                    r, a = 0.01 * np.sqrt(rng.random(80)), rng.random(80) * 2 * np.pi
                    at = np.stack((lat + r * np.sin(a), lon + r * np.cos(a)), axis=1)
                else:
                    along = np.linspace(0, 0.2, 96)
                    at = np.stack((lat + along, lon + along), axis=1) + rng.normal(0, 0.002, (96, 2))
                flow = [(s * np.sin(d), s * np.cos(d)) for s, d in ((rng.uniform(0.05, 0.8), rng.random() * 2 * np.pi), (0.03 * rng.uniform(2, 15), rng.random() * 2 * np.pi))]
                before, steps = hull_polygon(at), int(hours * 60 / minutes)
                for _ in range(steps):
                    move = np.sum(flow, axis=0) * minutes * 60 + rng.normal(0, 20, at.shape)
                    at = at + move / (1000 * G.KM_PER_DEGREE) / np.stack((np.ones(len(at)), np.cos(np.radians(at[:, 0]))), axis=1)
                after = hull_polygon(at)
                if before and after:
                    out.append((int(i), "point" if point else "line", before, after, hours, "simple"))
            yield pd.DataFrame(out, columns=["pair", "release_type", "initial_shape", "resulting_shape", "elapsed_hours", "backend"])

    return spark.range(n).mapInPandas(run, DRIFT)


def convex_hulls(points: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Per group the corners of its hull (group, corners) and its area.

    Each task first reduces its own points to hulls, so that a group of any size meets as few corners.
    """
    kind = points.schema[group].dataType.simpleString()

    def corners(p: pd.DataFrame) -> np.ndarray:
        return kernels.hull(p[["x", "y"]].to_numpy(dtype=float))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for b in batches:
            for g, p in b.groupby("g"):
                both = np.concatenate((held[g], p[["x", "y"]].to_numpy(dtype=float))) if g in held else p[["x", "y"]].to_numpy(dtype=float)
                held[g] = kernels.hull(both)
        for g, p in held.items():
            yield pd.DataFrame({"g": g, "x": p[:, 0], "y": p[:, 1]})

    def whole(p: pd.DataFrame) -> pd.DataFrame:
        c = corners(p)
        u, v = c.T
        area = abs(float((u * np.roll(v, -1) - np.roll(u, -1) * v).sum())) / 2
        return pd.DataFrame({"g": [p["g"].iloc[0]], "corners": [c.tolist()], "area": [area]})

    some = points.select(F.col(group).alias("g"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("g IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    few = some.mapInPandas(partial, f"g {kind}, x double, y double")
    return few.groupBy("g").applyInPandas(whole, f"g {kind}, corners array<array<double>>, area double").withColumnRenamed("g", group)
