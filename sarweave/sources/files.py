"""Trees of files as tables: listings, headers, scene catalogues, lines of pixels. All reading is Spark's, from any store."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarweave.config import DEFAULT, RASTER_EXTENSIONS, Config
from sarweave.functions import names as N
from sarweave.operators import joins
from sarweave.sources import images

ANY_CASE = "{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e) for e in RASTER_EXTENSIONS) + "}"


def _binary(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (r.option("pathGlobFilter", pattern) if pattern else r).load(root)


def _relative(root: str) -> Column:
    """Path below root, whatever the store's scheme puts before it."""
    tail = root.rstrip("/").split("://")[-1].lstrip("/")
    return F.element_at(F.split(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), rf"\Q{tail}\E/", 2), -1)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """rel, folder, stem, suffix, size and is_mask of all files; contents are not read."""
    f = _binary(spark, root).select(_relative(root).alias("rel"), F.col("length").alias("size"))
    r = F.col("rel")
    return f.select("rel", N.parent(r).alias("folder"), N.stem(r).alias("stem"), N.suffix(r).alias("suffix"), "size", N.is_mask_path(r).alias("is_mask"))


HEADER = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("width", "height", "count")]
    + [T.StructField(n, T.StringType()) for n in ("dtype", "crs")]
    + [T.StructField("transform", T.ArrayType(T.DoubleType())), T.StructField("time", T.StringType()), T.StructField("error", T.StringType())]
)


@F.pandas_udf(HEADER)
def read_header(content: pd.Series) -> pd.DataFrame:
    out = []
    for c in content:
        try:
            out.append({**images.header(c), "error": None})
        except Exception as e:  # a corrupt file is a row with its error
            out.append({**dict.fromkeys(HEADER.names), "error": f"{type(e).__name__}: {e}"[:200]})
    return pd.DataFrame(out, columns=HEADER.names, dtype=object)


def probe(spark: SparkSession, root: str) -> DataFrame:
    """Files that are rasters by name, with their header or the error that reading it gave."""
    f = _binary(spark, root, f"*.{ANY_CASE}").select(_relative(root).alias("rel"), F.col("length").alias("size"), read_header("content").alias("h"))
    return f.where(N.is_raster(F.col("rel"))).select("rel", "size", "h.*")


def scenes(probed: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """One row per scene: images paired by polarisation, masks found by key and rank, ids made unique, labels and calibration by rule."""
    r = F.col("rel")
    files = probed.where("error IS NULL").select("*", N.parent(r).alias("folder"), N.stem(r).alias("stem"), N.is_mask_path(r).alias("is_mask"))
    masks = files.where("is_mask").select(N.pairing_key(F.col("stem")).alias("key"), F.col("rel").alias("mask"), F.col("folder").alias("mask_folder"))
    images_ = files.where("NOT is_mask").select("folder", N.without_polarisation(F.col("stem")).alias("base"), N.polarisation(F.col("stem")).alias("pol"), r.alias("path"))
    paired = joins.pair_polarisations(images_)
    first = F.element_at("band_files", 1)
    head = files.select(F.col("rel").alias("first"), "width", "height", "count", "dtype", "crs", "transform", "time")
    s = paired.withColumn("first", first).join(head, "first")
    tags = F.when((F.col("count") >= 2) & (F.size("band_files") == 1), F.concat(F.array(F.lit("VV"), F.lit("VH")), F.transform(F.filter(F.sequence(F.lit(1), F.col("count")), lambda i: i >= 3), lambda i: F.concat(F.lit("B"), i.cast("string"))))).otherwise(F.col("pol_tags"))
    s = s.withColumn("pol_tags", tags).withColumn("key", F.lower(N.without_mask_tokens(F.col("base"))))
    found = joins.find_masks(s.select("first", "key", "folder"), masks, N.mask_search_folders(F.col("folder")))
    s = s.join(found.select("first", "mask"), "first")
    times = s.groupBy("base").agg(F.count("*").alias("_times"))
    s = s.join(times, "base").withColumn("scene_id", N.scene_id(F.col("base"), F.col("folder"), F.col("_times")))
    return s.select(
        "scene_id", F.col("folder").alias("rel_folder"), "band_files", "pol_tags", F.col("mask").alias("mask_path"), "width", "height", "dtype", "crs", "transform", "time",
        (F.size("pol_tags") >= 2).alias("has_dual_pol"), N.default_label(F.col("first"), c).alias("default_label"), N.is_calibrated(F.col("first"), F.col("dtype"), c).alias("is_calibrated"),
    )


LINES = "rel string, band int, y int, v array<float>, error string"
#: Names that a semi-join may broadcast: some 20 MB.
MAX_RELS = 100_000


def read_bands(spark: SparkSession, root: str, rels: DataFrame | None = None) -> DataFrame:
    """All bands of rasters as lines (rel, band, y, v, error); a file that can't be decoded is one row with its error.

    Each content is read once, by the task that decodes it, and is never shuffled. rels narrows the files: up to
    MAX_RELS names before contents are handed to Python, more of them by their lines.
    """
    f = _binary(spark, root, f"*.{ANY_CASE}").select(_relative(root).alias("rel"), "content")
    few = False
    if rels is not None:
        rels = rels.select("rel").distinct()
        few = rels.limit(MAX_RELS + 1).count() <= MAX_RELS
        f = f.join(F.broadcast(rels), "rel", "left_semi") if few else f

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rel, content in zip(b["rel"], b["content"], strict=True):
                try:
                    for band, a in enumerate(images.decode_bands(content)):
                        yield pd.DataFrame({"rel": rel, "band": band, "y": np.arange(len(a), dtype=np.int32), "v": list(a.astype(np.float32)), "error": None})
                except Exception as e:  # told where the file is wanted
                    yield pd.DataFrame({"rel": [rel], "band": [None], "y": [None], "v": [None], "error": [f"{rel}: {type(e).__name__}: {e}"[:300]]})

    lines = f.mapInPandas(run, LINES)
    return lines if rels is None or few else lines.join(rels, "rel", "left_semi")


def sound(lines: DataFrame) -> DataFrame:
    """lines without error; a row that has one ends the query with it. In the projection, as a filter could move below a join."""
    return lines.withColumn("v", F.when(F.col("error").isNull(), F.col("v")).otherwise(F.raise_error(F.col("error")).cast("array<float>"))).drop("error")


def read_lines(spark: SparkSession, root: str, rels: DataFrame | None = None, band: int = 0) -> DataFrame:
    """One band of rasters as lines (rel, y, v)."""
    return sound(read_bands(spark, root, rels).where(F.coalesce("band", F.lit(band)) == band)).drop("band")
