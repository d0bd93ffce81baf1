import duckdb
import pytest

from folioforge.llm import queries

D = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]


@pytest.mark.parametrize("name", ["op4_embedding_dedup", "op7_near_dedup"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS FROM '{D}/{t}.parquet'")
    df = queries.queries()[name](spark, D)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.collect())) == sorted(rel.select(*df.columns).fetchall())
