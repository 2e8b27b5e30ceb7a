"""Every query of the verification engine against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from skillgrid.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: None if v is None else round(v, 5) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not here")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = plain(df.collect(), df.columns)
    found = duck.execute(registry.ORACLE[name])
    want = plain(found.fetchall(), [c[0] for c in found.description])
    assert sorted(df.columns) == sorted(c[0] for c in found.description)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=2e-4), (name, a, b)
