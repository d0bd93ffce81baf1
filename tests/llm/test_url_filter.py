import duckdb
import pytest

from folioforge.llm.queries import URL_RULES, op9_url_filter, oracle_sql
from folioforge.llm.url_filter import filter_urls

CASES = [
    (1, "https://www.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/"),
    (2, "http://example.com/en/1", "example.com", "/en/1", "example.com/en/"),
    (3, "http://a.example.com/fr/", "a.example.com", "/fr/", "com/"),
    (4, "http://a.net/es/x", "a.net", "/es/x", "net/es/"),
    (5, "http://a.com", "a.com", "", None),
    (6, "no scheme", "", "", None),
    (7, None, "", "", None),
    (8, "http://notcom/x", "notcom", "/x", None),
    (9, "x://h.org?u=http://b.com/", "h.org", "", None),
    (10, "", "", "", None),
    (11, "http://É.net/fr/é", "É.net", "/fr/é", "net/fr/"),
    (12, "http://a.org/" + "z" * 20000, "a.org", "/" + "z" * 20000, None),
    (12, "http://a.org/b#c", "a.org", "/b", None),
]


def test_rules_hosts_and_paths(spark):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u, *_ in CASES], "page_id long, url string, host string, g int")
    got = filter_urls(df, URL_RULES).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule or "") for r in got) == sorted((i, h, p, r or "") for i, _, h, p, r in CASES)
    what = {rule: v for v, rule in URL_RULES}
    assert all(r.verdict == what[r.rule] for r in got if r.rule) and {r.verdict for r in got} <= {"allow", "block"}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "http://b.org/x"), (2, "http://b.org/x")]])
def test_without_training_urls_all_are_allowed(spark, rows):
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()
    assert len(got) == len(rows) and all(r.verdict == "allow" for r in got)


def test_models_tell_kinds_apart(spark):
    good = [(i, f"http://garden{i}.com/roses/tulips") for i in range(40)]
    bad = [(100 + i, f"http://xxwin{i}.net/fr/casino777") for i in range(40)]
    new = [(200, "http://garden.org/tulips/roses"), (201, "http://xxwin.org/casino777/77")]
    got = {r.page_id: r.verdict for r in filter_urls(spark.createDataFrame(good + bad + new, "page_id long, url string"), URL_RULES).collect()}
    assert got[200] == "allow" and got[201] == "block"


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS FROM '{sf_dir}/pages.parquet'")
    want = con.sql(oracle_sql()["op9_url_filter"]).fetchall()
    df = op9_url_filter(spark, sf_dir)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op9_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
