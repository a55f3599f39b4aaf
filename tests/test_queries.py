"""Every registered query of the library's own operators against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from concordia.plans import base, composite, files, fused, landed, large, model, published, relational, scalar, serving  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query(spark, oracle, name):
    df = base.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in base.SQL:
        assert got
        return
    found = oracle.execute(base.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert not [d for d in found.description if "HUGEINT" in str(d[1])]
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
