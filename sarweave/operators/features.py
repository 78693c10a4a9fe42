"""Object features of scenes: shapes from masks, radiometry from calibrated bands. One scene is one group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sarweave.config import DEFAULT, Config
from sarweave.operators import kernels
from sarweave.operators.raster import TEXTURE, grid, shapes

RADIOMETRY = ("damping_ratio", "damping_ratio_db", "boundary_gradient_steepness", "backscatter_variance_ratio", "glcm_contrast", "glcm_homogeneity", "ndpi")
FIELDS = (
    "scene_id string, instance_index int, mask_value int, area_px int, bbox_x int, bbox_y int, bbox_w int, bbox_h int, truncated_by_scene_edge boolean, "
    "centroid_x int, centroid_y int, perimeter double, boundary_complexity double, aspect_ratio double, fragment_count int, " + ", ".join(f"{n} double" for n in RADIOMETRY)
)


def _sobel(a: np.ndarray) -> np.ndarray:
    p = np.pad(a.astype(float), 1, mode="reflect" if min(a.shape) > 1 else "edge")
    across = p[:, 2:] - p[:, :-2]
    down = p[2:] - p[:-2]
    gx = across[:-2] + 2 * across[1:-1] + across[2:]
    gy = down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]
    return np.hypot(gx, gy)


def radiometry(vv: np.ndarray, vh: np.ndarray | None, mask: np.ndarray, label: np.ndarray, k: int, box: tuple[int, int, int, int], c: Config = DEFAULT) -> dict[str, float | None]:
    """Features of one object (k in label) from decibels, within its box and a margin; None where they can't be told."""
    out: dict[str, float | None] = dict.fromkeys(RADIOMETRY)
    h, w = mask.shape
    x, y, bw, bh = box
    pad = c.ring + 2
    part = np.s_[max(0, y - pad) : min(h, y + bh + pad), max(0, x - pad) : min(w, x + bw + pad)]
    obj = label[part] == k
    ring = kernels.dilate(obj, kernels.disc(c.ring)) & (mask[part] == 0)
    inner, outer = vv[part][obj].astype(float), vv[part][ring].astype(float)
    power = lambda db: np.power(10.0, db / 10)
    if len(inner) and len(outer):
        out["damping_ratio_db"] = float(outer.mean() - inner.mean())
        out["damping_ratio"] = float(power(outer).mean() / max(power(inner).mean(), 1e-12))
        out["backscatter_variance_ratio"] = float(inner.var() / max(outer.var(), 1e-6))
        line = np.zeros_like(obj)
        points = kernels.contour(obj)
        line[points[:, 1], points[:, 0]] = True
        out["boundary_gradient_steepness"] = float(_sobel(vv[part])[kernels.dilate(line, kernels.disc(1))].mean())
        patch = vv[y : y + bh, x : x + bw]
        if patch.size >= 64 and min(patch.shape) >= 4:
            gray = ((np.clip(patch, c.db_low, c.db_high) - c.db_low) / (c.db_high - c.db_low) * 255).astype(np.uint8)
            out["glcm_contrast"], out["glcm_homogeneity"] = kernels.glcm(gray, TEXTURE)
    if vh is not None and len(inner):
        a, b = power(inner), power(vh[part][obj].astype(float))
        ok = np.abs(a + b) > 1e-12
        if ok.any():
            out["ndpi"] = float(((a[ok] - b[ok]) / (a[ok] + b[ok])).mean())
    return out


def measure(lines: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """Of lines (scene_id, kind, y, v): kind mask has classes, VV and VH decibels. Objects of all scenes with a mask of their size and a positive pixel.

    Scenes without band lines get shapes only.
    """

    def run(t: pa.Table) -> pa.Table:
        grids = {}
        kinds = np.array(t["kind"].to_pylist())
        for kind in sorted({"mask", "VV", "VH"} & set(kinds.tolist())):
            grids[kind] = grid(t.filter(pa.array(kinds == kind)))[0].astype(np.float32)
        rows = []
        mask = grids.get("mask")
        vv, vh = grids.get("VV"), grids.get("VH")
        if mask is not None and (vv is None or vv.shape == mask.shape) and (mask > 0).any():
            classes = mask.astype(np.int32)
            _, fragments = kernels.components(classes > 0)
            for value, k, label, s in shapes(classes, c.min_area):
                more = radiometry(vv, vh, classes, label, k, (s["x"], s["y"], s["w"], s["h"]), c) if vv is not None else dict.fromkeys(RADIOMETRY)
                rows.append((t["scene_id"][0].as_py(), len(rows), value, s["area"], s["x"], s["y"], s["w"], s["h"], s["truncated"], s["cx"], s["cy"], s["perimeter"], s["complexity"], s["aspect"], fragments, *more.values()))
        types = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        fields = [f.split() for f in FIELDS.split(", ")]
        return pa.table([pa.array([r[i] for r in rows], types[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])

    return lines.select("scene_id", "kind", "y", "v").groupBy("scene_id").applyInArrow(run, FIELDS)
