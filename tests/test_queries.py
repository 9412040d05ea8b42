"""Every registered query of the engine against its SQL at the smallest scale; those without SQL must run."""

import collections
import glob
import math
import os

import duckdb
import pytest

from voxtrail.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.8g}") + 0.0
    return norm(float(v)) if type(v).__name__ == "Decimal" else v


def test_every_sql_has_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES) and registry.FLAGSHIP in registry.QUERIES


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if name in registry.ORACLE:
        rel = db.sql(registry.ORACLE[name])
        assert sorted(rel.columns) == cols
        want = collections.Counter(tuple(norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall())
        assert got == want
