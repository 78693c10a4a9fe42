"""Every query of the engine against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from sarweave.catalog import FLAGSHIP, ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(table):
    cols = sorted(table.column_names)
    return sorted((tuple(cell(r[c]) for c in cols) for r in table.to_pylist()), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    assert len(set(got.column_names)) == len(got.column_names)
    if name not in ORACLES:
        assert got.num_rows
        return
    want = duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows(got) == rows(want)


def test_flagship():
    assert FLAGSHIP in QUERIES and os.path.isdir(SF)
