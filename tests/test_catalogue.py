import math

import duckdb
import pytest

from folioforge import catalogue

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{D}/{t}.parquet'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([("" if r[i] is None else round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, D)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name in catalogue.oracle_sql():
        rel = con.sql(catalogue.oracle_sql()[name])
        assert sorted(rel.columns) == sorted(df.columns)
        a, b = plain(got, df.columns), plain(rel.fetchall(), rel.columns)
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x == y or all(p == q or (isinstance(p, float) and math.isclose(p, q, rel_tol=1e-9)) for p, q in zip(x, y)), (x, y)
