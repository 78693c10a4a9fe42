"""Composite tables: scene catalogues, crop plans, unified tiles, hulls, keyed randomness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sarweave.functions import names as N
from sarweave.functions import radiometry as R
from sarweave.functions import scalars as S
from sarweave.operators import geo, joins
from sarweave.queries import ORACLES, query, relational, table  # noqa: F401
from sarweave.queries import raster as rq
from sarweave.queries.names import paths

_RANKED = ORACLES["mask_pairing_ranked"]
_CTES = _RANKED[: _RANKED.rindex("\nSELECT")]


@query(f"""{_CTES},
one AS (SELECT p_partkey, mask FROM j WHERE n = 1),
f AS (SELECT k.p_partkey, folder, path, mask, CASE WHEN regexp_matches(stem, '(?i)^(vv|vh)$') OR NOT regexp_matches(stem, '(?i)[_\\-.](vv|vh)$') THEN stem ELSE regexp_replace(regexp_replace(stem, '(?i)[_\\-.](vv|vh)$', ''), '[_\\-. ]+$', '') END AS base,
  nullif(upper(regexp_extract(stem, '(?i)(?:^|[_\\-.])(vv|vh)$', 1)), '') AS pol FROM k JOIN one USING (p_partkey) WHERE NOT is_mask),
split_ AS (SELECT folder, base FROM f WHERE pol IS NOT NULL GROUP BY ALL),
g AS (SELECT folder, base, count(*) AS n_files, min(mask) AS mask FROM f WHERE pol IS NOT NULL OR NOT EXISTS (SELECT 1 FROM split_ s WHERE s.folder = f.folder AND s.base = f.base) GROUP BY folder, base)
SELECT folder, base, n_files, mask IS NOT NULL AS has_mask, count(*) OVER (PARTITION BY base) > 1 AS base_repeats FROM g""")
def scene_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of a list of files: bands paired, masks found, repeated bases told."""
    p = F.col("path")
    files = paths(spark, sf_dir).select("path", N.parent(p).alias("folder"), N.stem(p).alias("stem"), N.is_mask_path(p).alias("is_mask"))
    files = files.withColumn("key", N.pairing_key(F.col("stem")))
    masks = files.where("is_mask").select("key", F.col("path").alias("mask"), F.col("folder").alias("mask_folder"))
    images = files.where("NOT is_mask").select("folder", N.without_polarisation(F.col("stem")).alias("base"), N.polarisation(F.col("stem")).alias("pol"), "path", "key")
    found = joins.find_masks(images.select("path", "key", "folder").distinct(), masks, F.array("folder")).select("path", "mask")
    split = images.where("pol IS NOT NULL").select("folder", "base").distinct()
    stacked = images.where("pol IS NULL").join(split, ["folder", "base"], "left_anti")
    every = images.where("pol IS NOT NULL").unionByName(stacked).join(found, "path")
    scenes = every.groupBy("folder", "base").agg(F.count("*").alias("n_files"), F.min("mask").alias("mask"))
    times = scenes.groupBy("base").agg(F.count("*").alias("times"))
    return scenes.join(times, "base").select("folder", "base", "n_files", F.col("mask").isNotNull().alias("has_mask"), (F.col("times") > 1).alias("base_repeats"))


_COMPACT = ORACLES["compact_crops"]
_AT = _COMPACT.rindex("\nSELECT")


@query(f"""{_COMPACT[:_AT]}, {rq.NEGATIVE[len(rq.CLS) + 2:]},
positive AS ({_COMPACT[_AT:]}),
every AS (SELECT scene, instance_index, xoff, yoff FROM positive UNION ALL SELECT scene::INT, NULL, x0::INT, y0::INT FROM negative)
SELECT scene, instance_index, xoff, yoff, (row_number() OVER (PARTITION BY scene ORDER BY instance_index IS NULL, instance_index, yoff, xoff) - 1)::INT AS seq, CASE WHEN instance_index IS NULL THEN 'background' ELSE 'object' END AS label,
  format('{{}}_crop{{:03d}}', scene, row_number() OVER (PARTITION BY scene ORDER BY instance_index IS NULL, instance_index, yoff, xoff) - 1) AS crop_id FROM every""")
def crop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of each scene in sequence: objects first, background after, with their ids."""
    pos = rq.compact_crops(spark, sf_dir).select("scene", "instance_index", "xoff", "yoff")
    neg = rq.negative_windows(spark, sf_dir).select(F.col("scene").cast("int").alias("scene"), F.lit(None).cast("int").alias("instance_index"), F.col("x0").cast("int").alias("xoff"), F.col("y0").cast("int").alias("yoff"))
    order = Window.partitionBy("scene").orderBy(F.col("instance_index").isNull(), "instance_index", "yoff", "xoff")
    out = pos.unionByName(neg).withColumn("seq", (F.row_number().over(order) - 1).cast("int"))
    label = F.when(F.col("instance_index").isNull(), "background").otherwise("object")
    return out.select("scene", "instance_index", "xoff", "yoff", "seq", label.alias("label"), N.crop_id(F.col("scene").cast("string"), F.col("seq")).alias("crop_id"))


@query(f"""WITH {rq.PIX}, m AS (SELECT scene, min(v) AS lo, max(v) AS hi FROM pix GROUP BY scene),
g AS (SELECT scene, y // 20 AS ty, x // 20 AS tx, trunc(greatest(0, least(255, (v - lo) / (hi - lo) * 255)))::INT AS g FROM pix JOIN m USING (scene))
SELECT scene, ty::BIGINT AS ty, tx::BIGINT AS tx, sum(g)::BIGINT AS total, count(*) AS pixels, 400 - count(*) AS padded FROM g GROUP BY scene, ty, tx""")
def unify_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes stretched to 8 bits and cut into tiles of 20 x 20, padded at the edges."""
    ln = rq.lines(spark, sf_dir)
    span = ln.groupBy("scene").agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi"))
    g = ln.join(span, "scene").withColumn("v", F.transform("v", lambda v: R.scaled_8bit(v, F.col("lo"), F.col("hi"))))
    parts = F.transform(F.sequence(F.lit(0), F.ceil(F.size("v") / 20) - 1), lambda i: F.slice("v", (i * 20 + 1).cast("int"), F.lit(20)))
    t = g.select("scene", F.floor(F.col("y") / 20).alias("ty"), F.posexplode(parts).alias("tx", "part"))
    total = F.sum(F.aggregate("part", F.lit(0).cast("bigint"), lambda s, x: s + x))
    out = t.groupBy("scene", "ty", F.col("tx").cast("bigint").alias("tx")).agg(total.alias("total"), F.sum(F.size("part")).alias("pixels"))
    return out.withColumn("padded", 400 - F.col("pixels"))


@query("""SELECT c_custkey, round(('0x' || substr(sha1('42|draw|' || c_custkey), 1, 8))::BIGINT / 4294967296.0, 9) AS draw, (('0x' || substr(sha1('42|side|' || c_custkey), 1, 8))::BIGINT / 4294967296.0) < 0.5 AS left_side FROM customer""")
def keyed_rng_determinism(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed draws that no order of rows or tasks changes."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(S.unit(k, 42, "draw"), 9).alias("draw"), (S.unit(k, 42, "side") < 0.5).alias("left_side"))


@query("""WITH p AS (SELECT DISTINCT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
side AS (SELECT a.label, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM p a JOIN p b ON a.label = b.label AND (a.x != b.x OR a.y != b.y)),
outer_ AS (SELECT s.* FROM side s WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.label = s.label AND (bx - ax) * (c.y - ay) - (by_ - ay) * (c.x - ax) < 0))
SELECT label, count(*)::INT AS n_corners, round(sum(ax * by_ - bx * ay) / 2, 9) AS area FROM outer_ GROUP BY label""")
def convex_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hull of the points of each label: corners and area."""
    e = table(spark, sf_dir, "embeddings").select("label", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    h = geo.convex_hulls(e, "label", "x", "y")
    return h.select("label", F.size("corners").alias("n_corners"), F.round("area", 9).alias("area"))


@query(f"""WITH {rq.CLS} SELECT scene, y, list_sum(list(v ORDER BY x)) IS NOT NULL AS filled, (sum((v > 0.15)::INT))::BIGINT AS positive FROM cls GROUP BY scene, y""")
def mask_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives of each line of each mask."""
    c = rq.classes(spark, sf_dir)
    return c.select("scene", "y", (F.size("v") > 0).alias("filled"), F.size(F.filter("v", lambda v: v == 1)).cast("bigint").alias("positive"))
