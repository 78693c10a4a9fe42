"""Raster operators against plain versions."""

import numpy as np

from sarweave.operators import raster


def test_window_sums(spark):
    r = np.random.default_rng(3)
    scenes = {s: r.integers(0, 5, (h, w)) for s, (h, w) in enumerate([(40, 17), (8, 8), (7, 30), (12, 5), (300, 9)])}
    rows = [(s, y, [None if v == 4 else int(v) for v in g[y]]) for s, g in scenes.items() for y in range(len(g)) if (s, y) != (0, 11)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
        for side, step in ((8, 4), (8, 1), (1, 1), (3, 5)):
            want = set()
            for s, g in scenes.items():
                g = np.where(g == 4, 0, g)
                if s == 0:
                    g[11] = 0
                h, w = g.shape
                want |= {(s, y, x, int(g[y : y + side, x : x + side].sum())) for y in range(0, h - side + 1, step) for x in range(0, w - side + 1, step)}
            lines = spark.createDataFrame(rows, "scene int, y int, v array<int>").repartition(5)
            got = [tuple(t) for t in raster.window_sums(lines, side, step).collect()]
            assert len(got) == len(want) and set(got) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_window_sums_of_nothing(spark):
    assert raster.window_sums(spark.createDataFrame([], "scene string, y int, v array<int>"), 8, 4).count() == 0
