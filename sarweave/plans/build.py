"""The whole build: from a tree of rasters to tiles, tables, splits and findings, stage by stage.

Each stage is a function of tables and writes one below dest/state, which the next reads; a stage
whose table is there is not run again unless asked to. The tables are Parquet, so that a build can stop and go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sarweave.config import DEFAULT, FORMULA_NATIVE, FORMULA_POWER, Config
from sarweave.functions import geodesy as G
from sarweave.functions import names as N
from sarweave.functions import radiometry as R
from sarweave.functions import scalars as S
from sarweave.operators import aggregates, features, geo, joins, raster, sampling, splits
from sarweave.plans import qa
from sarweave.session import exists
from sarweave.sources import corridors, files, sinks

STAGES = ("scenes", "lines", "instances", "places", "crops", "tiles", "rows", "splits", "findings")


def scan(spark: SparkSession, root: str, c: Config) -> DataFrame:
    return files.scenes(files.probe(spark, root), c)


def band_lines(spark: SparkSession, root: str, scenes: DataFrame) -> DataFrame:
    """Lines (scene_id, kind, y, v) of masks and of bands as they are stored."""
    stacked = (F.size("band_files") == 1) & (F.size("pol_tags") > 1)
    bands = scenes.select("scene_id", "band_files", stacked.alias("stacked"), F.posexplode("pol_tags").alias("i", "kind"))
    bands = bands.select("scene_id", "kind", F.when(F.col("stacked"), F.col("band_files")[0]).otherwise(F.get("band_files", F.col("i"))).alias("rel"), F.when(F.col("stacked"), F.col("i")).otherwise(0).alias("band"))
    masks = scenes.where("mask_path IS NOT NULL").select("scene_id", F.lit("mask").alias("kind"), F.col("mask_path").alias("rel"), F.lit(0).alias("band"))
    wanted = bands.unionByName(masks)
    lines, w = files.read_bands(spark, root).alias("l"), wanted.alias("w")
    same = (F.col("l.rel") == F.col("w.rel")) & (F.coalesce("l.band", "w.band") == F.col("w.band"))
    return files.sound(lines.join(w, same).select("scene_id", "kind", "y", "v", "error"))


def decibels(lines: DataFrame, scenes: DataFrame, c: Config) -> DataFrame:
    """Masks, and bands of calibrated scenes as decibels by the domain of their middle."""
    kind = lines.where("kind != 'mask'").join(scenes.select("scene_id", "is_calibrated", "dtype", "height", "width"), "scene_id").where("is_calibrated")
    middle = kind.where((F.abs(F.col("y") - F.col("height") / 2) <= 128)).select("scene_id", "kind", F.explode(F.slice("v", F.greatest(F.floor(F.col("width") / 2 - 128) + 1, F.lit(1)).cast("int"), F.lit(256))).alias("x"))
    finite = middle.where(~F.isnan("x") & (F.abs("x") < float("inf")))
    domain = finite.groupBy("scene_id", "kind").agg(F.min("x").alias("low"), F.percentile("x", 0.99).alias("p99"))
    domain = domain.select("scene_id", "kind", R.value_domain(F.col("low"), F.col("p99"), F.lit(False)).alias("domain"))
    by = F.col("domain")
    db = kind.join(domain, ["scene_id", "kind"]).withColumn("v", F.transform("v", lambda x: F.when(by == "db", x).when(by == "power", R.to_db(x, False, c)).otherwise(R.to_db(x, True, c)).cast("float")))
    return lines.where("kind = 'mask'").unionByName(db.select("scene_id", "kind", "y", "v"))


def locate(spark: SparkSession, scenes: DataFrame, c: Config) -> DataFrame:
    """scene_id, frame (origin and degrees per pixel), whether it is synthetic, corridor, offset and time of each scene: the file's own, or else a synthetic one."""
    real = G.is_georeferenced(F.col("crs"), F.col("transform")) & (F.col("crs") == "EPSG:4326")
    own = F.struct(F.col("transform")[5].alias("lat0"), F.col("transform")[2].alias("lon0"), (-F.col("transform")[4]).alias("dlat"), F.col("transform")[0].alias("dlon"))
    made = geo.synthetic_locations(scenes.select("scene_id"), "scene_id", corridors.corridors(spark), c.offset_scale_km, c.seed)
    s = scenes.select("scene_id", "width", "height", "time", F.coalesce(real, F.lit(False)).alias("real"), own.alias("own")).join(made, "scene_id")
    frame = G.frame(F.col("lat"), F.col("lon"), F.col("width"), F.col("height"), c.pixel_m)
    off = S.seed_of(F.concat(F.lit("ts|"), "scene_id")) % 315619199
    return s.select(
        "scene_id", F.when(F.col("real"), F.col("own")).otherwise(frame).alias("frame"), (~F.col("real")).alias("is_synthetic_location"),
        F.when(~F.col("real"), F.col("corridor")).alias("source_corridor_id"), F.when(~F.col("real"), F.round("offset_km", 6)).alias("offset_km"),
        F.col("time").isNull().alias("is_synthetic_timestamp"), F.coalesce("time", F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit("2016-01-01 00:00:00").cast("timestamp")) + off), S.ISO)).alias("timestamp_utc"),
    )


def plan(scenes: DataFrame, instances: DataFrame, lines: DataFrame, c: Config) -> DataFrame:
    """Windows of all scenes: objects that fit get one, larger ones tiles with a positive pixel, and background windows far from every positive."""
    size = c.tile
    i = instances.join(scenes.select("scene_id", "width", "height", "default_label"), "scene_id")
    label = F.when(F.col("mask_value") == c.lookalike_value, "lookalike").otherwise(F.col("default_label"))
    i = i.withColumns({"label": label, "parent_group_id": S.group_id(F.col("scene_id"), F.col("instance_index").cast("string"))})
    keep = ["scene_id", "instance_index", "label", "parent_group_id", "truncated_by_scene_edge"]
    fits = (F.col("bbox_w") <= size) & (F.col("bbox_h") <= size)
    jitter = lambda salt: S.seed_of(F.concat_ws("|", F.lit(f"{c.seed}|{salt}"), "scene_id", F.col("instance_index").cast("string"))) % (2 * c.jitter + 1) - c.jitter
    inside = lambda v, n: F.greatest(F.lit(0), F.least(v, F.col(n) - size)).cast("int")
    compact = i.where(fits).select(*keep, inside(F.col("centroid_x") - size // 2 + jitter("jx"), "width").alias("xoff"), inside(F.col("centroid_y") - size // 2 + jitter("jy"), "height").alias("yoff"), F.lit(False).alias("is_partial"))
    xs = raster.axis_positions(F.col("bbox_x"), F.col("bbox_w"), F.col("width"), size, c.stride)
    ys = raster.axis_positions(F.col("bbox_y"), F.col("bbox_h"), F.col("height"), size, c.stride)
    tx, ty = raster.thinned(xs, ys, c.max_tiles)
    tiles = i.where(~fits).select(*keep, F.explode(ty).alias("yoff"), tx.alias("xs")).select(*keep, "yoff", F.explode("xs").alias("xoff"))
    masks = lines.where("kind = 'mask'").select("scene_id", "y", "v")
    rows = tiles.select("scene_id", "xoff", "yoff").distinct().withColumn("y", F.explode(F.sequence(F.col("yoff"), F.col("yoff") + size - 1)))
    filled = rows.join(masks, ["scene_id", "y"]).where(F.exists(F.slice("v", F.col("xoff") + 1, F.lit(size)), lambda v: v > 0)).select("scene_id", "xoff", "yoff").distinct()
    overflow = tiles.join(filled, ["scene_id", "xoff", "yoff"], "left_semi").withColumn("is_partial", F.lit(True))
    positive = masks.select(F.col("scene_id").alias("scene"), "y", F.posexplode("v").alias("x", "v")).where("v > 0").drop("v")
    with_mask = masks.select("scene_id").distinct()
    sizes = scenes.join(with_mask, "scene_id", "left_semi").where((F.col("width") >= size) & (F.col("height") >= size)).select(F.col("scene_id").alias("scene"), F.col("height").alias("h"), F.col("width").alias("w"))
    clear = raster.clear_windows(positive, sizes, size, max(1, size // 2), c.neg_buffer).withColumn("key", F.concat_ws("|", "scene", F.col("y0").cast("string"), F.col("x0").cast("string")))
    counts = sizes.select(F.col("scene").alias("scene_id")).join(instances.groupBy("scene_id").agg(F.count("*").alias("n")), "scene_id", "left")
    want = F.least(F.when(F.col("n").isNull(), c.neg_per_empty).otherwise(F.greatest(F.lit(1), F.bround(F.col("n") * c.neg_ratio, 0))), F.lit(c.neg_cap)).cast("int")
    ranked = clear.withColumn("place", F.row_number().over(Window.partitionBy("scene").orderBy(sampling.sample_key("key", c.seed), "key")))
    negative = ranked.withColumnRenamed("scene", "scene_id").join(counts.select("scene_id", want.alias("want")), "scene_id").where("place <= want")
    negative = negative.select("scene_id", F.lit(None).cast("int").alias("instance_index"), F.lit("background").alias("label"), S.group_id(F.col("scene_id"), F.lit("neg")).alias("parent_group_id"), F.lit(False).alias("truncated_by_scene_edge"), F.col("x0").alias("xoff"), F.col("y0").alias("yoff"), F.lit(False).alias("is_partial"))
    every = compact.unionByName(overflow).unionByName(negative)
    order = Window.partitionBy("scene_id").orderBy(F.col("instance_index").isNull(), "instance_index", "yoff", "xoff")
    return every.withColumn("seq", (F.row_number().over(order) - 1).cast("int")).withColumn("crop_id", N.crop_id(F.col("scene_id"), F.col("seq")))


def cut(crops: DataFrame, lines: DataFrame, decibel: DataFrame, scenes: DataFrame, c: Config) -> DataFrame:
    """PNG tiles (name, content): calibrated bands of 16 bits, others as they are, and masks of 0 and 255; pixels outside a scene are 0."""
    size = c.tile
    calibrated = decibel.where("kind != 'mask'").withColumn("v", F.transform("v", lambda x: R.to_uint16(x.cast("double"), c))).withColumn("bits", F.lit(16))
    masks = lines.where("kind = 'mask'").withColumn("v", F.transform("v", lambda x: F.when(x > 0, 255).otherwise(0))).withColumn("bits", F.lit(8))
    native = lines.where("kind != 'mask'").join(scenes.where("NOT is_calibrated").select("scene_id", F.when(F.col("dtype") == "uint16", 16).otherwise(8).alias("bits")), "scene_id")
    native = native.select("scene_id", "kind", "y", F.transform("v", lambda x: x.cast("int")).alias("v"), "bits")
    source = calibrated.unionByName(masks).unionByName(native)
    kinds = source.select("scene_id", "kind", "bits").distinct()
    rows = crops.select("scene_id", "crop_id", "xoff", "yoff").join(kinds, "scene_id").withColumn("y", F.explode(F.sequence(F.col("yoff"), F.col("yoff") + size - 1)))
    window = F.transform(F.sequence(F.col("xoff"), F.col("xoff") + size - 1), lambda x: F.coalesce(F.get("v", x), F.lit(0)))
    got = rows.join(source.drop("bits"), ["scene_id", "kind", "y"], "left").select("crop_id", "kind", "bits", "y", F.when(F.col("v").isNotNull(), window).otherwise(F.array_repeat(F.lit(0), size)).alias("row"))
    tiles = got.groupBy("crop_id", "kind", "bits").agg(F.array_sort(F.collect_list(F.struct("y", "row"))).alias("rows"))
    return sinks.png_tiles(tiles.select(F.concat("crop_id", F.lit("_"), "kind", F.lit(".png")).alias("name"), F.col("rows.row").alias("lines"), "bits"))


def crop_rows(crops: DataFrame, scenes: DataFrame, places: DataFrame, instances: DataFrame, c: Config) -> DataFrame:
    """The crop table: all columns of the geodata and master tables."""
    shape = instances.select("scene_id", "instance_index", "area_px", "perimeter", "boundary_complexity", "aspect_ratio")
    t = crops.join(scenes.select("scene_id", "rel_folder", "is_calibrated", "has_dual_pol", "band_files"), "scene_id").join(places, "scene_id").join(shape, ["scene_id", "instance_index"], "left")
    corner = G.corners(F.col("frame"), F.col("xoff"), F.col("yoff"), F.lit(c.tile), F.lit(c.tile))
    t = t.withColumn("c", corner)
    zero = lambda x, places_: F.bround(F.coalesce(x, F.lit(0.0)), places_)
    mid = lambda k: F.bround((F.col("c")[0][k] + F.col("c")[2][k]) / 2, 6)
    out: dict[str, Column] = {
        "crop_id": F.col("crop_id"), "crop_source_scene_id": F.col("scene_id"), "is_calibrated": F.col("is_calibrated"), "has_dual_pol": F.col("has_dual_pol"),
        "is_synthetic_location": F.col("is_synthetic_location"), "crop_bbox_corners": G.format_corners(F.col("c")), "is_partial_object": F.col("is_partial"),
        "parent_group_id": F.col("parent_group_id"), "truncated_by_scene_edge": F.col("truncated_by_scene_edge"),
        "db_conversion_formula_version": F.when(F.col("is_calibrated"), FORMULA_POWER).otherwise(FORMULA_NATIVE), "label": F.col("label"),
        "full_extent_area_px": F.coalesce("area_px", F.lit(0)), "full_extent_perimeter": zero(F.col("perimeter"), 4),
        "full_extent_boundary_complexity": zero(F.col("boundary_complexity"), 6), "full_extent_aspect_ratio": zero(F.col("aspect_ratio"), 6),
        "image_id": F.col("crop_id"), "dataset_source": F.element_at(F.split("rel_folder", "/"), 1), "width": F.lit(c.tile), "height": F.lit(c.tile),
        "has_real_geo": ~F.col("is_synthetic_location"), "lat": mid("lat"), "lon": mid("lon"), "timestamp_utc": F.col("timestamp_utc"),
        "source_corridor_id": F.col("source_corridor_id"), "offset_km": F.col("offset_km"), "crop_xoff": F.col("xoff"), "crop_yoff": F.col("yoff"),
        "crop_size": F.lit(c.tile), "source_scene_relpath": F.col("band_files")[0], "is_synthetic_timestamp": F.col("is_synthetic_timestamp"), "rel_folder": F.col("rel_folder"),
    }
    return t.select(*(v.alias(k) for k, v in out.items()))


def check(rows: DataFrame, manifest: DataFrame, tiles: DataFrame) -> DataFrame:
    """Findings over the finished tables."""
    named = tiles.where("name LIKE '%_mask.png' OR name LIKE '%_VV.png'").select(F.regexp_replace("name", "_(VV|VH|mask).png$", "").alias("crop_id"))
    return qa.guarded(rows.sparkSession, [
        ("schema", "cells", lambda: qa.several(rows, "schema", [
            ("required cells", "hard", S.nullish(F.col("crop_id")) | S.nullish(F.col("label")) | S.nullish(F.col("crop_bbox_corners"))),
            ("label vocabulary", "hard", ~F.col("label").isin("oil", "lookalike", "background")),
            ("coordinates on the map", "hard", ~G.at_sea(F.col("lat"), F.col("lon"))),
            ("aspect at least 1", "soft", (F.col("full_extent_area_px") > 0) & (F.col("full_extent_aspect_ratio") < 1)),
        ])),
        ("schema", "unique ids", lambda: qa.empty(aggregates.duplicates(rows, "crop_id"), "schema", "unique ids", "hard", "repeated ids")),
        ("files", "tiles and rows agree", lambda: qa.empty(joins.missing_both_ways(rows, named, ["crop_id"]), "files", "tiles and rows agree", "hard", "ids of one side")),
        ("splits", "no scene in two splits", lambda: qa.empty(splits.leaks(manifest, "crop_source_scene_id"), "splits", "no scene in two splits", "hard", "leaking scenes")),
        ("splits", "every crop in a split", lambda: qa.empty(rows.join(manifest, "image_id", "left_anti"), "splits", "every crop in a split", "hard", "crops without a split")),
    ])


def build(spark: SparkSession, root: str, dest: str, c: Config = DEFAULT, fresh: bool = True, upto: str = STAGES[-1]) -> dict[str, DataFrame]:
    """Run the stages up to one; the tables by name. With fresh False finished stages are taken as they are; one that was stopped on its way is run again."""
    done: dict[str, DataFrame] = {}

    def stage(name: str, make) -> bool:
        path = f"{dest}/state/{name}"
        if not fresh:
            if exists(spark, f"{path}/_SUCCESS"):
                done[name] = spark.read.parquet(path)
                return name != upto
        make().write.mode("overwrite").parquet(path)
        done[name] = spark.read.parquet(path)
        return name != upto

    steps = {
        "scenes": lambda: scan(spark, root, c),
        "lines": lambda: band_lines(spark, root, done["scenes"]),
        "instances": lambda: features.measure(decibels(done["lines"], done["scenes"], c), c),
        "places": lambda: locate(spark, done["scenes"], c),
        "crops": lambda: plan(done["scenes"], done["instances"], done["lines"], c),
        "tiles": lambda: cut(done["crops"], done["lines"], decibels(done["lines"], done["scenes"], c), done["scenes"], c),
        "rows": lambda: crop_rows(done["crops"], done["scenes"], done["places"], done["instances"], c),
        "splits": lambda: done["rows"].join(splits.assign_splits(done["rows"], "crop_source_scene_id", "label", c), "crop_source_scene_id").select("image_id", "split", "crop_source_scene_id", "label"),
        "findings": lambda: check(done["rows"], done["splits"], done["tiles"]),
    }
    for name in STAGES:
        if not stage(name, steps[name]):
            break
    if "splits" in done:
        sinks.write_by_folder(done["rows"], f"{dest}/geodata")
        sinks.write_master(done["rows"].drop("rel_folder"), f"{dest}/metadata")
        sinks.write_splits(done["splits"], f"{dest}/splits")
    return done
