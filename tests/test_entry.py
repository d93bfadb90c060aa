"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import importlib
import math
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
entry_module = importlib.import_module("__spark_entry__")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    found = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(map(plain, r)) for r in found.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr) == want


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns[0] == "spatial_id"


@pytest.mark.parametrize("name", ["h3_cells", "h3_area", "h3_boundary", "h3_crime_counts", "isochrone_area"])
def test_queries_without_sql_give_rows(spark, name):
    assert entry_module.queries()[name](spark, SF).count() > 0
