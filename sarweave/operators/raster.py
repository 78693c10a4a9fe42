"""Raster operators: scenes as rows of arrays, one row per image line.

lines: (scene, y, v ARRAY<DOUBLE>), a compact form in which a line moves through a shuffle as one
row. Neighbouring lines come by lag and lead, neighbouring pixels by array functions; kernels that
need a whole scene (components, contours) run once per scene over Arrow.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sarweave.operators import kernels

#: Offsets (dy, dx) of the texture measure: distances 1 and 3 at four angles.
TEXTURE = ((0, 1), (1, 1), (1, 0), (1, -1), (0, 3), (2, 2), (3, 0), (2, -2))


def pixels(lines: DataFrame) -> DataFrame:
    """(scene, y, x, v)."""
    return lines.select("scene", "y", F.posexplode("v").alias("x", "v"))


def map_lines(lines: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    return lines.withColumn("v", F.transform("v", f))


def neighbour_lines(lines: DataFrame) -> DataFrame:
    """lines with up and down, mirrored at the borders without repeating the border line."""
    w = Window.partitionBy("scene").orderBy("y")
    up, down = F.lag("v").over(w), F.lead("v").over(w)
    return lines.withColumns({"up": up, "down": down}).select("scene", "y", "v", F.coalesce("up", "down", "v").alias("up"), F.coalesce("down", "up", "v").alias("down"))


def gradient(lines: DataFrame) -> DataFrame:
    """Magnitude of the 3 x 3 Sobel gradient of each pixel, as lines."""
    near = neighbour_lines(lines)
    n = F.size("v")

    def at(c: str, x: Column) -> Column:
        inside = F.when(x < 0, -x).when(x >= n, 2 * n - 2 - x).otherwise(x)
        return F.get(F.col(c), F.greatest(F.lit(0), inside).cast("int"))

    def size(x: Column) -> Column:
        left, right = x - 1, x + 1
        gx = (at("up", right) + 2 * at("v", right) + at("down", right)) - (at("up", left) + 2 * at("v", left) + at("down", left))
        gy = (at("down", left) + 2 * at("down", x) + at("down", right)) - (at("up", left) + 2 * at("up", x) + at("up", right))
        return F.sqrt(gx * gx + gy * gy)

    return near.select("scene", "y", F.transform(F.sequence(F.lit(0), n - 1), size).alias("v"))


def texture(lines: DataFrame, low: float = -30.0, high: float = 0.0) -> DataFrame:
    """Contrast and homogeneity of each scene: decibels cut to 8 bits, co-occurrences over TEXTURE, mean of the offsets.

    Pairs of a line and the line dy below are formed as arrays and summed in place, so that
    no pixel pair becomes a row.
    """
    gray = map_lines(lines, lambda v: F.greatest(F.lit(0.0), F.least(F.lit(255.0), (v - low) / (high - low) * 255)).cast("int"))
    w = Window.partitionBy("scene").orderBy("y")
    gray = gray.withColumns({f"d{dy}": F.lead("v", dy).over(w) for dy in (1, 2, 3)}).withColumn("d0", F.col("v"))
    sums = []
    for i, (dy, dx) in enumerate(TEXTURE):
        a = F.slice("v", 1 + max(0, -dx), F.greatest(F.size("v") - abs(dx), F.lit(0)))
        b = F.slice(f"d{dy}", 1 + max(0, dx), F.greatest(F.size("v") - abs(dx), F.lit(0)))
        diff = F.zip_with(a, b, lambda p, q: (p - q).cast("double") * (p - q))
        total = lambda d, f: F.aggregate(d, F.lit(0.0), lambda s, x: s + f(x))
        sums += [F.sum(total(diff, lambda x: x)).alias(f"c{i}"), F.sum(total(diff, lambda x: 1 / (1 + x))).alias(f"h{i}"), F.sum(F.size(diff).cast("double") * diff.isNotNull().cast("int")).alias(f"n{i}")]
    each = gray.groupBy("scene").agg(*sums)
    mean = lambda k: sum((F.col(f"{k}{i}") / F.col(f"n{i}") for i in range(1, len(TEXTURE))), F.col(f"{k}0") / F.col("n0")) / len(TEXTURE)
    return each.select("scene", mean("c").alias("contrast"), mean("h").alias("homogeneity"))


def window_sums(lines: DataFrame, side: int, step: int) -> DataFrame:
    """Of lines of whole numbers: the sum of each window of side x side whose origin (y0, x0) lies on a grid of step.

    The integral image is built line by line, in order of y, from a scene's first line on; only its last side lines are
    held, however long the scene. A line that is missing and a null pixel count as zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scene, y, held = None, 0, deque(maxlen=side + 1)
        for b in batches:
            out: list[tuple] = []
            for name, line, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                row = np.concatenate(([0], np.cumsum(pc.fill_null(v.values, 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
                if name != scene:
                    scene, y = name, line
                    held.clear()
                    held.append(np.zeros_like(row))
                while y <= line:
                    held.append(held[-1] + row if y == line else held[-1])
                    y += 1
                    if len(held) > side and (y - side) % step == 0:
                        x0 = np.arange(0, len(row) - side, step)
                        total = held[-1] - held[0]
                        out.append((name, y - side, x0, total[x0 + side] - total[x0]))
            n = [len(o[2]) for o in out]
            flat = lambda k: np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64)  # noqa: B023, E731
            place = np.repeat(np.array([o[1] for o in out], np.int64), n)
            name = pa.array([o[0] for o in out], b.schema.field(0).type).take(pa.array(np.repeat(np.arange(len(out)), n)))
            yield pa.RecordBatch.from_arrays([name, pa.array(place), pa.array(flat(2).astype(np.int32)), pa.array(flat(3))], names=["scene", "y0", "x0", "total"])

    kind = lines.schema["scene"].dataType.simpleString()
    ordered = lines.select("scene", F.col("y").cast("long"), "v").repartition("scene").sortWithinPartitions("scene", "y")
    return ordered.mapInArrow(run, f"scene {kind}, y0 long, x0 int, total long")


def clear_windows(positive: DataFrame, sizes: DataFrame, side: int, step: int, buffer: int) -> DataFrame:
    """Windows on a grid that keep buffer pixels away from every positive (scene, y, x). sizes: (scene, h, w).

    Each positive names the few grid windows near to it; those are taken from all windows by
    an anti join, so that no pixel meets a window that is far away.
    """
    starts = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(F.col(n) - side, F.lit(0)), F.lit(step)), lambda s: s + side <= F.col(n))
    windows = sizes.select("scene", F.explode(starts("h")).alias("y0"), starts("w").alias("xs")).select("scene", "y0", F.explode("xs").alias("x0"))
    near = lambda c: F.sequence(F.floor((F.col(c) - side - buffer) / step).cast("int"), F.floor((F.col(c) + buffer) / step).cast("int") + 1)
    hits = positive.select("scene", "y", "x", F.explode(near("y")).alias("gy"), near("x").alias("xs")).select("scene", "y", "x", "gy", F.explode("xs").alias("gx"))
    hits = hits.select("scene", "y", "x", (F.col("gy") * step).alias("y0"), (F.col("gx") * step).alias("x0"))
    off = lambda c, o: F.greatest(F.col(o) - F.col(c), F.col(c) - F.col(o) - (side - 1), F.lit(0))
    blocked = hits.where(off("y", "y0") ** 2 + off("x", "x0") ** 2 < buffer * buffer).select("scene", "y0", "x0").distinct()
    return windows.join(blocked, ["scene", "y0", "x0"], "left_anti")


def axis_positions(start: Column, length: Column, limit: Column, size: int, stride: int) -> Column:
    """Origins of windows along one axis that cover length pixels from start, inside limit, evenly spread at stride at most."""
    clamp = lambda v: F.greatest(F.lit(0), F.least(v, F.greatest(limit - size, F.lit(0)))).cast("int")
    first, span = start, length - size
    n = F.greatest(F.ceil(span / stride), F.lit(0)).cast("int") + 1
    step = F.when(n > 1, span / (n - 1)).otherwise(0.0)
    mid = F.when(span <= 0, start + F.floor(span / 2)).otherwise(first)
    return F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda i: clamp(F.bround(mid + i * step, 0)))))


def thinned(xs: Column, ys: Column, budget: int) -> tuple[Column, Column]:
    """Every second origin of the longer axis goes until the tiles are within budget; eight halvings at most are ever needed for 256 x 256 origins."""
    both = F.struct(xs.alias("x"), ys.alias("y"))

    def half(a: Column) -> Column:
        return F.filter(a, lambda _, i: i % 2 == 0)

    def step(s: Column, _: Column) -> Column:
        over = F.size(s["x"]) * F.size(s["y"]) > budget
        wide = F.size(s["x"]) >= F.size(s["y"])
        return F.struct(F.when(over & wide, half(s["x"])).otherwise(s["x"]).alias("x"), F.when(over & ~wide, half(s["y"])).otherwise(s["y"]).alias("y"))

    out = F.aggregate(F.sequence(F.lit(1), F.lit(16)), both, step)
    return out["x"], out["y"]


INSTANCE = (
    "scene int, mask_value int, instance_index int, area int, x int, y int, w int, h int, first_y int, first_x int, "
    "truncated boolean, cx int, cy int, perimeter double, complexity double, aspect double"
)


def grid(t: pa.Table, size: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lines (y, v) of one scene as a grid in order of y, and the y. Taken from Arrow's flat values; a null pixel is 0.

    With a size (h, w) each line lies at its y in a grid of that size; lines that are missing are zeros.
    """
    y = t["y"].to_numpy()
    flat = pc.fill_null(pa.concat_arrays(c.flatten() for c in t["v"].chunks), 0).to_numpy(zero_copy_only=False)
    if size is not None:
        if y.min() < 0 or y.max() >= size[0]:
            raise ValueError(f"lines {y.min()} to {y.max()} do not fit a scene of {size[0]}")
        out = np.zeros(size, flat.dtype)
        out[y] = flat.reshape(len(y), size[1])
        return out, np.arange(size[0])
    order = np.argsort(y, kind="stable")
    return flat.reshape(len(y), -1)[order], y[order]


def shapes(classes: np.ndarray, min_area: int):
    """For each component that is large enough: its class, its number and the label grid, and its shape. By class, then by first pixel.

    One sort by label gives the pixels of all components; the rest of the work is in each one's box.
    """
    h, w = classes.shape
    for value in sorted({int(v) for v in np.unique(classes)} - {0}):
        label, n = kernels.components(classes == value)
        every_y, every_x = np.nonzero(label)
        owner = label[every_y, every_x]
        area = np.bincount(owner, minlength=n + 1)
        ends = np.cumsum(area)
        by_owner = np.argsort(owner, kind="stable")
        for k in np.flatnonzero(area >= max(min_area, 1)):
            mine = by_owner[ends[k] - area[k] : ends[k]]
            ys, xs = every_y[mine], every_x[mine]
            x, y, x2, y2 = int(xs.min()), int(ys.min()), int(xs.max()), int(ys.max())
            points = kernels.contour(label[y : y2 + 1, x : x2 + 1] == k)
            length = kernels.perimeter(points)
            axes = (kernels.ellipse_axes(points) if len(points) >= 5 else None) or kernels.box_axes(points)
            middle = kernels.polygon_centroid(points)
            cx, cy = (int(middle[0]) + x, int(middle[1]) + y) if middle else (x + (x2 - x + 1) // 2, y + (y2 - y + 1) // 2)
            yield value, int(k), label, {
                "area": int(area[k]), "x": x, "y": y, "w": x2 - x + 1, "h": y2 - y + 1, "first_y": int(ys[0]), "first_x": int(xs[0]),
                "truncated": bool(x == 0 or y == 0 or x2 == w - 1 or y2 == h - 1), "cx": cx, "cy": cy,
                "perimeter": length, "complexity": length * length / int(area[k]), "aspect": axes[0] / axes[1] if axes[1] > 1e-6 else 1.0,
            }


def instances(classes: DataFrame, min_area: int = 20, size: tuple[int, int] | None = None) -> DataFrame:
    """Of class lines (scene, y, v ARRAY<INT>, 0 is background): the 8-connected components of each class that are large enough, with shapes.

    One scene is one group; instance_index counts by class, then by first pixel in raster order. Without a size (h, w) of the scenes, a scene
    is the lines it has, side by side; with it, missing lines are background and the border is that of the size.
    """

    def run(t: pa.Table) -> pa.Table:
        rows = [(t["scene"][0].as_py(), v, i, *s.values()) for i, (v, _, _, s) in enumerate(shapes(grid(t, size)[0].astype(np.int32), min_area))]
        kinds = [pa.int32()] * 10 + [pa.bool_(), pa.int32(), pa.int32()] + [pa.float64()] * 3
        names = [f.split()[0] for f in INSTANCE.split(", ")]
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return classes.select(F.col("scene").cast("int"), "y", "v").groupBy("scene").applyInArrow(run, INSTANCE)


def labelled_pixels(classes: DataFrame, min_area: int = 1) -> DataFrame:
    """(scene, mask_value, component, y, x) of all pixels in components that are large enough; component: the first pixel as y * 2**20 + x."""

    def run(t: pa.Table) -> pa.Table:
        classes_, lines = grid(t)
        parts = []
        for value in sorted({int(v) for v in np.unique(classes_)} - {0}):
            label, n = kernels.components(classes_ == value)
            area = np.bincount(label.ravel(), minlength=n + 1)
            ys, xs = np.nonzero((label > 0) & (area[label] >= min_area))
            k = label[ys, xs]
            kinds, first = np.unique(label.ravel(), return_index=True)
            seed = first[np.searchsorted(kinds, k)].astype(np.int64)
            w = classes_.shape[1]
            parts.append((np.full(len(k), value), lines[seed // w].astype(np.int64) * (1 << 20) + seed % w if len(k) else seed, lines[ys], xs))
        cols = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0) for i in range(4)]
        scene = np.full(len(cols[0]), t["scene"][0].as_py())
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(c).cast(k) for c, k in zip((scene, *cols), kinds, strict=True)], names=["scene", "mask_value", "component", "y", "x"])

    return classes.select(F.col("scene").cast("int"), F.col("y").cast("int"), "v").groupBy("scene").applyInArrow(run, "scene int, mask_value int, component long, y int, x int")


def dilated(points: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Of (scene, component, y, x): all pixels that an offset away from the component, each once. The kernel is a literal."""
    kernel = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets))
    moved = points.withColumn("k", F.explode(kernel))
    return moved.select("scene", "component", (F.col("y") + F.col("k.dy")).alias("y"), (F.col("x") + F.col("k.dx")).alias("x")).distinct()
