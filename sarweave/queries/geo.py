"""Geospatial queries over customers, events and ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.functions import geodesy as G
from sarweave.functions import scalars as S
from sarweave.operators import geo
from sarweave.queries import query, table
from sarweave.sources import corridors as C

_LINES = ", ".join(f"({k}, '{i}', {w}::DOUBLE, [{', '.join(f'{{lat: {a}::DOUBLE, lon: {b}::DOUBLE}}' for a, b in p)}])" for k, (i, w, p) in enumerate(C.CORRIDORS))
SEGS = f"""lane AS (SELECT * FROM (VALUES {_LINES}) AS t(idx, id, weight, points)),
segs AS (SELECT idx, id, weight, seg, points[seg + 1].lat AS lat1, points[seg + 1].lon AS lon1, points[seg + 2].lat AS lat2, points[seg + 2].lon AS lon2 FROM (SELECT *, unnest(range(len(points) - 1)) AS seg FROM lane))"""
PLACES = "places AS (SELECT c_custkey, (c_custkey % 60)::DOUBLE - 5 AS lat, (c_custkey * 7 % 170)::DOUBLE - 60 AS lon FROM customer)"
_BEARING = "(degrees(atan2(sin(radians(lon2 - lon1)) * cos(radians(lat2)), cos(radians(lat1)) * sin(radians(lat2)) - sin(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2 - lon1)))) + 360) % 360"
_HAVERSINE = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))"
_UNIT = "('0x' || substr(sha1('{salt}|' || {key}), 1, 8))::BIGINT / 4294967296.0"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", ((k % 60).cast("double") - 5).alias("lat"), ((k * 7 % 170).cast("double") - 60).alias("lon"))


@query(f"WITH {SEGS} SELECT id, seg::INT AS seg, weight, lat1, lon1, lat2, lon2, round({_HAVERSINE}, 6) AS km, round({_BEARING}, 6) AS bearing FROM segs")
def corridor_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corridors from GeoJSON text, cut into segments with length and bearing."""
    s = C.segments(C.corridors(spark))
    ends = [F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")]
    return s.select("id", "seg", "weight", *ends, F.round(G.haversine_km(*ends), 6).alias("km"), F.round(G.bearing(*ends), 6).alias("bearing"))


_FLAT = """e AS (SELECT *, 111.32 * cos(radians(lat)) AS east FROM both_),
a AS (SELECT *, (lon1 - lon) * east AS ax, (lat1 - lat) * 111.32 AS ay, (lon2 - lon1) * east AS dx, (lat2 - lat1) * 111.32 AS dy FROM e),
t AS (SELECT *, greatest(0, least(1, coalesce(-(ax * dx + ay * dy) / nullif(dx * dx + dy * dy, 0), 0))) AS t FROM a),
k AS (SELECT *, sqrt(pow(ax + t * dx, 2) + pow(ay + t * dy, 2)) AS km FROM t)"""


@query(f"""WITH {SEGS}, {PLACES}, both_ AS (SELECT * FROM places, segs), {_FLAT}
SELECT c_custkey, id AS corridor, round(km, 6) AS km, round({_BEARING}, 6) AS bearing FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY km, id, seg) AS n FROM k) WHERE n = 1""")
def nearest_corridor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest corridor segment of each place, its distance and bearing."""
    out = geo.nearest_segment(places(spark, sf_dir), C.segments(C.corridors(spark)))
    return out.select("c_custkey", F.col("near.id").alias("corridor"), F.round("near.km", 6).alias("km"), F.round("near.bearing", 6).alias("bearing"))


_U = {n: _UNIT.format(salt=f"42|{n}", key="c_custkey") for n in ("pick", "seg", "t", "r", "a", "side")}
SYNTHETIC = f"""{SEGS}, w AS (SELECT *, sum(weight) OVER (ORDER BY idx) / sum(weight) OVER () AS high, weight / sum(weight) OVER () AS part FROM lane),
c AS (SELECT c_custkey, {", ".join(f"{v} AS u_{k}" for k, v in _U.items())} FROM customer),
p AS (SELECT c.*, w.id, floor(u_seg * (len(points) - 1))::INT AS seg, points FROM c JOIN w ON u_pick < high AND u_pick >= high - part),
q AS (SELECT *, points[seg + 1].lat AS lat1, points[seg + 1].lon AS lon1, points[seg + 2].lat - points[seg + 1].lat AS dlat, points[seg + 2].lon - points[seg + 1].lon AS dlon, abs(sqrt(-2 * ln(1 - u_r)) * cos(2 * pi() * u_a)) * 50.0 AS km, CASE WHEN u_side < 0.5 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS side FROM p),
r AS (SELECT *, lat1 + u_t * dlat AS lat0, lon1 + u_t * dlon AS lon0 FROM q),
s AS (SELECT *, dlon * cos(radians(lat0)) AS east, dlat AS north, greatest(cos(radians(lat0)), 1e-6) AS c FROM r),
synthetic AS (SELECT c_custkey, id AS corridor, seg, lat0 + km / 111.32 * east * side / sqrt(east * east + north * north) AS lat,
  ((lon0 - km / 111.32 * north * side / sqrt(east * east + north * north) / c + 180) % 360 + 360) % 360 - 180 AS lon, km AS offset_km FROM s)"""


@query(f"WITH {SYNTHETIC} SELECT c_custkey, corridor, seg, round(lat, 6) AS lat, round(lon, 6) AS lon, round(offset_km, 6) AS offset_km FROM synthetic")
def synthetic_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location beside a shipping corridor for each scene, by keyed hashes."""
    out = geo.synthetic_locations(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", C.corridors(spark))
    r = lambda c: F.round(c, 6).alias(c)
    return out.select("c_custkey", "corridor", "seg", r("lat"), r("lon"), r("offset_km"))


@query(f"""WITH {SYNTHETIC}, both_ AS (SELECT y.c_custkey, y.lat, y.lon, y.offset_km, g.lat1, g.lon1, g.lat2, g.lon2 FROM synthetic y JOIN segs g ON g.id = y.corridor AND g.seg = y.seg), {_FLAT}
SELECT c_custkey, round(km, 3) AS km, km <= greatest(offset_km + 15, 15) + 5 AS near FROM k""")
def perpendicular_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic locations against the segment that they were made from: distance, and whether it is plausible."""
    y = geo.synthetic_locations(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", C.corridors(spark))
    s = C.segments(C.corridors(spark)).withColumnRenamed("id", "corridor")
    km = G.segment_km(*(F.col(c) for c in ("lat", "lon", "lat1", "lon1", "lat2", "lon2")))
    both = y.join(F.broadcast(s), ["corridor", "seg"]).withColumn("km", km)
    return both.select("c_custkey", F.round("km", 3).alias("km"), (F.col("km") <= F.greatest(F.col("offset_km") + 15, F.lit(15.0)) + 5).alias("near"))


_COURSE = "((degrees(atan2(sin(radians({3} - {1})) * cos(radians({2})), cos(radians({0})) * sin(radians({2})) - sin(radians({0})) * cos(radians({2})) * cos(radians({3} - {1})))) + 360) % 360)"


@query(f"""WITH {SYNTHETIC}, b AS (SELECT y.c_custkey, y.lat, y.lon, g.lat1, g.lon1, g.lat2, g.lon2, (g.lon2 - g.lon1) * cos(radians(y.lat)) AS dx, g.lat2 - g.lat1 AS dy
  FROM synthetic y JOIN segs g ON g.id = y.corridor AND g.seg = y.seg WHERE y.offset_km >= 2),
t AS (SELECT *, greatest(0, least(1, coalesce(((lon - lon1) * cos(radians(lat)) * dx + (lat - lat1) * dy) / nullif(dx * dx + dy * dy, 0), 0))) AS t FROM b),
f AS (SELECT *, lat1 + t * (lat2 - lat1) AS flat, lon1 + t * (lon2 - lon1) AS flon FROM t),
d AS (SELECT c_custkey, abs({_COURSE.format("flat", "flon", "lat", "lon")} - {_COURSE.format("lat1", "lon1", "lat2", "lon2")}) AS d FROM f)
SELECT c_custkey, round(abs(least(d, 360 - d) - 90), 3) AS error_deg, abs(least(d, 360 - d) - 90) <= 15 AS square FROM d""")
def offset_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic locations 2 km or more off their line: by how much the offset misses a right angle, and whether by 15 degrees at most."""
    y = geo.synthetic_locations(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", C.corridors(spark)).where("offset_km >= 2")
    s = C.segments(C.corridors(spark)).withColumnRenamed("id", "corridor")
    ends = [F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")]
    off = G.bearing(*G.foot(F.col("lat"), F.col("lon"), *ends), F.col("lat"), F.col("lon"))
    error = F.abs(G.angle_between(off, G.bearing(*ends)) - 90)
    return y.join(F.broadcast(s), ["corridor", "seg"]).select("c_custkey", F.round(error, 3).alias("error_deg"), (error <= 15).alias("square"))


@query(f"""WITH {PLACES} SELECT c_custkey, count_if(abs(lat) > 45 OR abs(lon) > 100)::BIGINT AS outside, count_if(lat = 0 AND lon = 0)::BIGINT AS at_zero FROM places GROUP BY c_custkey HAVING outside > 0 OR at_zero > 0""")
def coords_in_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places out of a box, or at zero."""
    out = F.count_if((F.abs("lat") > 45) | (F.abs("lon") > 100))
    zero = F.count_if((F.col("lat") == 0) & (F.col("lon") == 0))
    return places(spark, sf_dir).groupBy("c_custkey").agg(out.alias("outside"), zero.alias("at_zero")).where("outside > 0 OR at_zero > 0")


@query(f"""WITH {PLACES}, f AS (SELECT c_custkey, lat, lon, 10.0 / 111320.0 AS dlat, 10.0 / (111320.0 * greatest(cos(radians(lat)), 1e-6)) AS dlon FROM places),
t AS (SELECT c_custkey, lat + 1000 * dlat - 256 * dlat AS top, lon - 1000 * dlon + 128 * dlon AS left_, dlat, dlon FROM f)
SELECT c_custkey, round_even(left_, 6) AS lon_tl, round_even(top, 6) AS lat_tl, round_even(left_ + 256 * dlon, 6) AS lon_br, round_even(top - 256 * dlat, 6) AS lat_br FROM t""")
def corners_format_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners of a window in a synthetic frame, written as text and read again."""
    p = places(spark, sf_dir)
    f = G.frame(F.col("lat"), F.col("lon"), F.lit(2000), F.lit(2000))
    text = G.format_corners(G.corners(F.col("f"), F.lit(128), F.lit(256), F.lit(256), F.lit(256)))
    c = p.withColumn("f", f).select("c_custkey", G.parse_corners(text).alias("c"))
    at = lambda i, k: F.col("c")[i][k]
    return c.select("c_custkey", at(0, "lon").alias("lon_tl"), at(0, "lat").alias("lat_tl"), at(2, "lon").alias("lon_br"), at(2, "lat").alias("lat_br"))


@query(f"""WITH {PLACES}, t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'EPSG:4326' END AS crs, c_custkey % 5 = 0 AS ident, lat, lon FROM places)
SELECT c_custkey, crs != '' AND NOT ident AS real_geo, CASE WHEN crs != '' AND NOT ident THEN round(lon + 0.0001 * 256, 6) END AS lon_c, CASE WHEN crs != '' AND NOT ident THEN round(lat - 0.0001 * 256, 6) END AS lat_c FROM t""")
def georef_corners_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes with a real georeference, and the position of a pixel by their transform."""
    k = F.col("c_custkey")
    ident = F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)))
    own = F.array(F.lit(0.0001), F.lit(0.0), F.col("lon"), F.lit(0.0), F.lit(-0.0001), F.col("lat"))
    p = places(spark, sf_dir).select("c_custkey", F.when(k % 3 == 0, "").otherwise("EPSG:4326").alias("crs"), F.when(k % 5 == 0, ident).otherwise(own).alias("t"))
    real = G.is_georeferenced(F.col("crs"), F.col("t"))
    x, y = G.affine(F.col("t"), F.lit(256), F.lit(256))
    return p.select("c_custkey", real.alias("real_geo"), F.when(real, F.round(x, 6)).alias("lon_c"), F.when(real, F.round(y, 6)).alias("lat_c"))


_TOTAL = f"m AS (SELECT *, {_HAVERSINE} AS km FROM segs), mm AS (SELECT *, coalesce(sum(km) OVER (PARTITION BY idx ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS km0, sum(km) OVER (PARTITION BY idx) AS total FROM m)"


@query(f"""WITH {SEGS}, {_TOTAL}, v AS (SELECT v, v % 8 AS idx, greatest(5.0, least(25.0, 8 + 12 * {_UNIT.format(salt="speed", key="v")})) AS knots FROM (SELECT unnest(range(40)) AS v)),
a AS (SELECT v.*, step, (step * knots * 1.852 * 10 / 60) % total AS s FROM v, (SELECT unnest(range(36)) AS step), (SELECT DISTINCT idx AS i, total FROM mm) t WHERE t.i = v.idx)
SELECT 200000000 + v AS mmsi, step::INT AS step, round(lat1 + (s - km0) / km * (lat2 - lat1), 6) AS lat, round(lon1 + (s - km0) / km * (lon2 - lon1), 6) AS lon, round({_BEARING}, 6) AS heading, round(knots, 6) AS speed_knots FROM a JOIN mm ON mm.idx = a.idx AND s >= km0 AND s < km0 + km""")
def vessel_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of forty vessels along the corridors."""
    lines = C.corridors(spark)
    t = geo.vessel_tracks(spark, lines, C.segments(lines), 40, 36)
    r = lambda c: F.round(c, 6).alias(c)
    return t.select("mmsi", "step", *map(r, ("lat", "lon", "heading", "speed_knots")))


@query()
def drift_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slicks before and after a day's drift, with polygons as JSON."""
    d = geo.drift_pairs(spark, 60)
    return d.select("pair", "release_type", F.to_json("initial_shape").alias("initial_shape"), F.to_json("resulting_shape").alias("resulting_shape"), "elapsed_hours", "backend")


@query("""SELECT c_custkey, strftime(TIMESTAMP '2016-01-01' + to_seconds(('0x' || substr(sha1('ts|' || c_custkey), 1, 8))::BIGINT % 315619199), '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc FROM customer""")
def synthetic_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time between 2016 and 2025 for each scene, by a keyed hash."""
    off = S.seed_of(F.concat(F.lit("ts|"), F.col("c_custkey").cast("string"))) % 315619199
    t = F.timestamp_seconds(F.unix_timestamp(F.lit("2016-01-01 00:00:00").cast("timestamp")) + off)
    return table(spark, sf_dir, "customer").select("c_custkey", F.date_format(t, S.ISO).alias("timestamp_utc"))


@query("""SELECT p_partkey, ('0x' || substr(sha1('wind|' || p_name), 1, 8))::BIGINT AS seed, round(greatest(0.3, least(25, 6 * sqrt(-2 * ln(1 - ('0x' || substr(sha1('wind|' || p_name), 1, 8))::BIGINT / 4294967296.0)))), 6) AS speed FROM part""")
def mock_wind_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mock wind: a Rayleigh draw from a hash, within its range."""
    seed = S.seed_of(F.concat(F.lit("wind|"), "p_name"))
    speed = F.greatest(F.lit(0.3), F.least(F.lit(25.0), 6 * F.sqrt(-2 * F.log(1 - seed / F.lit(4294967296.0)))))
    return table(spark, sf_dir, "part").select("p_partkey", seed.alias("seed"), F.round(speed, 6).alias("speed"))


@query("""WITH g0 AS (SELECT vec_id % 50 AS gy, unnest(range(64)) AS gx, vec_id // 50 % 2 AS part, unnest(embedding)::DOUBLE AS v FROM embeddings),
g AS (SELECT part, gy, gx, avg(v) AS v FROM g0 GROUP BY ALL),
p AS (SELECT c_custkey, (c_custkey % 490) / 10.0 AS y, (c_custkey % 630) / 10.0 AS x FROM customer),
n AS (SELECT c_custkey, round_even(y, 0)::BIGINT AS gy, round_even(x, 0)::BIGINT AS gx FROM p)
SELECT c_custkey, round(sqrt(u.v * u.v + w.v * w.v), 6) AS speed FROM n JOIN g u ON u.part = 0 AND u.gy = n.gy AND u.gx = n.gx JOIN g w ON w.part = 1 AND w.gy = n.gy AND w.gx = n.gx""")
def nearest_grid_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wind speed at the nearest grid point, from two component grids."""
    e = table(spark, sf_dir, "embeddings").select((F.floor(F.col("vec_id") / 50) % 2).alias("s"), (F.col("vec_id") % 50).alias("gy"), F.posexplode("embedding").alias("gx", "v"))
    grid = e.groupBy("gy", "gx").agg(*(F.avg(F.when(F.col("s") == i, F.col("v").cast("double"))).alias(n) for i, n in enumerate("uw")))
    k = F.col("c_custkey")
    p = table(spark, sf_dir, "customer").select("c_custkey", F.bround((k % 490) / 10.0, 0).cast("bigint").alias("gy"), F.bround((k % 630) / 10.0, 0).cast("int").alias("gx"))
    return p.join(grid, ["gy", "gx"]).select("c_custkey", F.round(F.sqrt(F.col("u") ** 2 + F.col("w") ** 2), 6).alias("speed"))


@query("""WITH g AS (SELECT vec_id // 50 AS scene, unnest(embedding)::DOUBLE AS v FROM embeddings) SELECT scene, round(avg(CASE WHEN v > 0.4 THEN NULL ELSE v END), 9) AS mean FROM g GROUP BY scene""")
def grid_mean_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of each component grid without its missing values."""
    e = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("scene"), F.explode("embedding").alias("v"))
    v = F.when(F.col("v").cast("double") > 0.4, float("nan")).otherwise(F.col("v").cast("double"))
    return e.groupBy("scene").agg(F.round(F.avg(F.nanvl(F.nullif(v, F.lit(float("nan"))), F.lit(None))), 9).alias("mean"))
