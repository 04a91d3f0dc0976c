"""Every registered query against its SQL twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from stratalens.catalog import load

FOLDER = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
REGISTRY = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=2e-6)
    return a == b


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    df = REGISTRY[name].run(spark, str(FOLDER))
    names = sorted(df.columns)
    ours = sorted((tuple(row[n] for n in names) for row in df.collect()), key=key)
    if REGISTRY[name].sql is None:
        assert ours and all(len(row) == len(names) for row in ours)
        return
    result = duck.execute(REGISTRY[name].sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    theirs = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


def test_one_query_reads_only_its_columns(spark):
    df = REGISTRY["ordinal_moments"].run(spark, str(FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "PushedFilters" in plan


def test_no_query_leaves_views(spark):
    assert not spark.catalog.listTables()
