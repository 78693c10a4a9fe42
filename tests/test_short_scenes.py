"""Queries of scenes that lack lines, against their SQL: scenes stay 50 x 64."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sarweave.catalog import ORACLES, QUERIES
from tests.test_queries import rows


@pytest.fixture(scope="module")
def short(tmp_path_factory):
    """A whole scene, one without its first and some inner lines, one of 6 lines, one of 32, and one of a single inner line."""
    r = np.random.default_rng(5)
    ids = [i for i in range(232) if not (i == 50 or 70 <= i < 74 or i % 50 == 37 and i > 50 or 106 <= i < 150 or 182 <= i < 200)] + [270]
    d = tmp_path_factory.mktemp("short")
    v = r.normal(0, 0.125, (len(ids), 64)).astype(np.float32)
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(list(v), pa.list_(pa.float32())), "label": pa.array([0] * len(ids), pa.int32())}), d / "embeddings.parquet")
    return str(d)


@pytest.mark.parametrize("name", ["components_area_bbox", "crop_rows", "fragment_count", "negative_windows", "pad_or_tile"])
def test_scenes_that_lack_lines(spark, short, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{short}/embeddings.parquet'")
    got, want = QUERIES[name](spark, short).toArrow(), c.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names) and want.num_rows
    assert rows(got) == rows(want)
