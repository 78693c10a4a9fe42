"""Sinks: tiles as PNG rows, tables partitioned by folder, master tables, splits, reports."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarweave.functions import scalars as S
from sarweave.sources import images

# Column order of the tables.
GEODATA_COLUMNS = (
    "crop_id", "crop_source_scene_id", "is_calibrated", "has_dual_pol", "is_synthetic_location", "crop_bbox_corners", "is_partial_object", "parent_group_id",
    "truncated_by_scene_edge", "db_conversion_formula_version", "label", "full_extent_area_px", "full_extent_perimeter", "full_extent_boundary_complexity", "full_extent_aspect_ratio",
)
YES_NO = ("is_calibrated", "has_dual_pol", "is_partial_object", "truncated_by_scene_edge")
TRUE_FALSE = ("is_synthetic_location", "is_synthetic_timestamp")


def ordered(rows: DataFrame, first: tuple[str, ...] = GEODATA_COLUMNS) -> DataFrame:
    """Known columns in their order, blank where missing, then all others."""
    rest = [c for c in rows.columns if c not in first]
    return rows.select(*(F.col(c) if c in rows.columns else F.lit("").alias(c) for c in first), *rest)


def rendered(rows: DataFrame) -> DataFrame:
    """Cells as text: flags in their two vocabularies, nulls blank."""
    cells = {c: S.yes_no(F.col(c)) for c in YES_NO if c in rows.columns}
    cells |= {c: F.when(S.truthy(F.col(c)), "true").otherwise("false") for c in TRUE_FALSE if c in rows.columns}
    return rows.select(*(cells.get(c, F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in rows.columns))


def write_by_folder(rows: DataFrame, path: str, folder: str = "rel_folder", mode: str = "overwrite") -> None:
    """One CSV part set per folder; with mode dynamic only the folders in rows are replaced, which resumes a build."""
    w = rendered(rows).write.option("header", True)
    w = w.option("partitionOverwriteMode", "dynamic") if mode == "dynamic" else w
    w.mode("overwrite").partitionBy(folder).csv(path)


def write_master(rows: DataFrame, path: str, key: str = "crop_id") -> None:
    """One table in order of its key, in as many files as Spark needs."""
    rendered(ordered(rows)).orderBy(key).write.mode("overwrite").option("header", True).csv(path)


def write_splits(manifest: DataFrame, path: str) -> None:
    """A folder for each split, and the manifest."""
    manifest.select("image_id", "split").write.mode("overwrite").partitionBy("split").option("header", True).csv(f"{path}/lists")
    manifest.orderBy("image_id").write.mode("overwrite").option("header", True).csv(f"{path}/manifest")


def png_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles (name, lines ARRAY<ARRAY<INT>>, bits) as (name, content): PNG bytes, to be written by any sink that takes binary rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            content = [images.encode_png(np.array([np.asarray(x) for x in t], dtype=np.uint16 if bits == 16 else np.uint8)) for t, bits in zip(b["lines"], b["bits"], strict=True)]
            yield pd.DataFrame({"name": b["name"], "content": content})

    return tiles.select("name", "lines", "bits").mapInPandas(run, "name string, content binary")


def write_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def write_report(report: DataFrame, path: str) -> None:
    """A small report as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
