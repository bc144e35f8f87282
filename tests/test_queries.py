"""Every query against its SQL twin on the smallest tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest
from fundloom.plans import registry

DIR = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if hasattr(v, "to_eng_string"):
        return round(float(v), 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, DIR)
    rows = df.collect()
    if name not in registry.oracle_sql():
        return
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=repr)
    at = [rel.columns.index(c) for c in order]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
