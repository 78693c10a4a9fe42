"""Join operators: ranked masks, cascades, both-way differences, pairing, nearest cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_masks(images: DataFrame, masks: DataFrame, searched: Column) -> DataFrame:
    """images (key, and others) with the mask of equal key that comes first: by place of its folder in searched, then least deep, then by path; null if none.

    masks: (key, mask, mask_folder). Masks are reduced to the first of each key and folder, and of each key,
    before they are joined, so that a key with many images and masks makes no pairs of them.
    """
    first = F.min(F.struct(F.size(F.split("mask", "/")).alias("depth"), "mask"))
    by_folder = masks.groupBy("key", F.col("mask_folder").alias("_folder")).agg(first.alias("_near"))
    anywhere = masks.groupBy("key").agg(first.alias("_any"))
    rows = images.withColumn("_id", F.struct(*images.columns))
    near = rows.select("_id", "key", F.posexplode(searched).alias("_place", "_folder")).join(by_folder, ["key", "_folder"])
    near = near.groupBy("_id").agg(F.min(F.struct("_place", "_near")).alias("_n"))
    out = rows.join(near, "_id", "left").join(anywhere, "key", "left")
    return out.select("_id.*", F.coalesce("_n._near.mask", "_any.mask").alias("mask"))


def cascade(left: DataFrame, steps: list[tuple[DataFrame, list[str]]], value: str) -> DataFrame:
    """left with value from the first of steps (a table with unique keys, and these) that has it, and the number of the step."""
    out = left
    for i, (right, on) in enumerate(steps):
        out = out.join(right.select(*on, F.col(value).alias(f"_v{i}")), on, "left")
    found = [F.col(f"_v{i}") for i in range(len(steps))]
    step = F.coalesce(*(F.when(v.isNotNull(), F.lit(i + 1)) for i, v in enumerate(found)))
    return out.withColumns({value: F.coalesce(*found), "step": step}).drop(*(f"_v{i}" for i in range(len(steps))))


def missing_both_ways(a: DataFrame, b: DataFrame, on: list[str], names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Keys that only one side has, and which side: one full outer join of distinct keys."""
    x, y = (d.select(*on).distinct().withColumn(f"_{n}", F.lit(True)) for d, n in ((a, 0), (b, 1)))
    both = x.join(y, on, "full_outer")
    return both.where("_0 IS NULL OR _1 IS NULL").select(*on, F.when(F.col("_0").isNull(), names[1]).otherwise(names[0]).alias("only_in"))


def pair_polarisations(files: DataFrame) -> DataFrame:
    """Of (folder, base, pol, path): one row per base with its tags and files, VV first; files without a tag come only where no split pair has their base."""
    split = files.where("pol IS NOT NULL").groupBy("folder", "base").agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("pol") == "VV", 0).otherwise(1).alias("o"), "pol", "path"))).alias("b"))
    split = split.select("folder", "base", F.col("b.pol").alias("pol_tags"), F.col("b.path").alias("band_files"))
    stacked = files.where("pol IS NULL").join(split, ["folder", "base"], "left_anti")
    return split.unionByName(stacked.select("folder", "base", F.array(F.lit("VV")).alias("pol_tags"), F.array("path").alias("band_files")))


def nearest_cell(points: DataFrame, grid: DataFrame, keep: list[str]) -> DataFrame:
    """Points (id, day, lat, lon) with the columns keep of the nearest grid row (day, glat, glon) of their day and one-degree cell; nulls where the cell is empty.

    Cells are joined by equality, so that a point meets only the rows of its own cell; the
    nearest is a minimum, which is combined before the shuffle.
    """
    cells = lambda d, lat, lon: d.withColumns({"_y": F.bround(F.col(lat), 0).cast("int"), "_x": F.bround(F.col(lon), 0).cast("int")})
    both = cells(points, "lat", "lon").join(cells(grid, "glat", "glon"), ["day", "_y", "_x"], "left")
    distance = F.abs(F.col("lat") - F.col("glat")) + F.abs(F.col("lon") - F.col("glon"))
    own = [c for c in points.columns]
    return both.groupBy(*own).agg(F.min_by(F.struct(*keep), F.struct(distance, "glat", "glon")).alias("n")).select(*own, *(F.col("n")[k].alias(k) for k in keep))
