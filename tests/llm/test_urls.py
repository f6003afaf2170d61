import datetime

import pytest

from panelforge.llm.queries import capture_times, dated_list, op1_url_lists, oracle_sql
from panelforge.llm.url_lists import canonical, url_list_join, validity_intervals

DAY = lambda d: datetime.date(2024, 1, 1) + datetime.timedelta(days=d)


def test_canonical(spark):
    cases = {
        "HTTPS://User@WWW.Example.COM.:8080/a/B?q=1#f": ("www.example.com", "/a/B?q=1"),
        "http://x.org": ("x.org", "/"),
        "http://x.org?q": ("x.org", "/?q"),
        "//x.org/a": ("x.org", "/a"),
        "mailto:a@b": (None, None), "": (None, None), "http:///p": (None, None),
    }
    df = spark.createDataFrame([(u,) for u in [*cases, None]], "u string")
    host, path = canonical(df["u"])
    found = {r.u: (r.h, r.p) for r in df.select("u", host.alias("h"), path.alias("p")).collect()}
    assert found == {**cases, None: (None, None)}


def test_intervals(spark):
    log = [("k", "c", "add", 5), ("k", "c", "add", 7), ("k", "c", "remove", 9), ("k", "c", "remove", 10), ("k", "c", "add", 12), ("k", "c", "remove", 12),
           ("k", "c", "add", 20), ("k", "d", "remove", 1), ("k", "d", "add", 3), ("k", "d", "add", 3), (None, "c", "add", 1), ("k", None, "add", 1), ("k", "c", "keep", 2)]
    rows = [(k, c, a, DAY(d)) for k, c, a, d in log] + [("k", "c", "add", None)]
    found = validity_intervals(spark.createDataFrame(rows, "key string, category string, action string, at date")).collect()
    assert sorted((r.category, r.valid_from, r.valid_to) for r in found if r.valid_to) == [("c", DAY(5), DAY(9))]
    assert sorted((r.category, r.valid_from) for r in found if not r.valid_to) == [("c", DAY(20)), ("d", DAY(3))]


def test_join_as_of_fetch_time(spark):
    entries = spark.createDataFrame(
        [("h:bad.org", "spam", "add", DAY(10)), ("h:bad.org", "spam", "remove", DAY(100)), ("p:ok.org/x/", "ads", "add", DAY(0)), ("u:ok.org/y?q=1", "one", "add", DAY(-400)), ("h:org", "all", "add", DAY(300))],
        "key string, category string, action string, at date",
    )
    urls = [("http://a.bad.org/", 9, ""), ("http://a.bad.org/", 10, "spam"), ("http://bad.org/", 99, "spam"), ("http://bad.org/", 100, ""), ("http://notbad.org/", 50, ""),
            ("http://ok.org/x/z", 1, "ads"), ("http://ok.org/x", 1, ""), ("http://ok.org/y?q=1#a", 1, "one"), ("http://ok.org/x/", 301, "ads,all"), (None, 5, ""), ("", 5, ""), ("http://bad.org/", None, "")]
    rows = [(i, u, None if d is None else DAY(d), "clash", 1) for i, (u, d, _) in enumerate(urls)]
    rows += [rows[1], rows[1]]
    captures = spark.createDataFrame(rows, "page_id int, url string, fetched_at date, key string, n int")
    found = url_list_join(captures, entries).collect()
    assert len(found) == len(rows)
    assert all(r.categories == urls[r.page_id][2] and r.blocked == (r.n_matches > 0) == bool(r.categories) for r in found)
    assert url_list_join(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_list_join(captures.limit(0), entries).count() == 0


def test_query_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    sf = "/root/testdata/sf0.001"
    found = op1_url_lists(spark, sf)
    rows = sorted(tuple(r) for r in found.select(sorted(found.columns)).collect())
    sql = con.execute(f"SELECT {', '.join(sorted(found.columns))} FROM ({oracle_sql()['op1_url_lists']})").fetchall()
    assert rows == sorted(sql, key=lambda r: tuple((x is None, x) for x in r)) or sorted(map(str, rows)) == sorted(map(str, sql))
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert dated_list(pages).count() > 0 and capture_times(pages).where("fetched_at is null").count() == 0


def test_plan_is_native(spark):
    plan = op1_url_lists(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
