import duckdb

from rankweave.llm import url_filter as uf


def judged(spark, urls, bad=()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame(list(bad), "page_id long, bad long")
    return {r.page_id: r for r in uf.judge_urls(pages, outcomes).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme.net/", "http://A.Example.NET/en/x?q#f", "http://example.net/fr/", "http://net/", "http://notnet/", "http://x.net",
            "ftp://example.com/de/1", "http://sub.example.com/de", "http://a.org/fr/", "://h?x/y", "http://É.org#/fr/", "http://b.net/a://c.org/"]
    got = judged(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.net", "/en/x", "example.net/en/"), ("example.net", "/fr/", "net/"), ("net", "/", "net/"),
        ("notnet", "/", None), ("x.net", "", None), ("example.com", "/de/1", "example.com/de/"), ("sub.example.com", "/de", None), ("a.org", "/fr/", "org/fr/"),
        ("h", "", None), ("É.org", "", None), ("b.net", "/a://c.org/", "net/")]
    assert [got[i].verdict for i in (3, 4, 8, 10, 0)] == ["allow", "block", "block", "allow", "allow"]
    assert judged(spark, []) == {}


def test_reputation_shrinks(spark):
    urls = [f"http://bad.one.com/{i}" for i in range(60)] + [f"http://good.two.com/{i}" for i in range(60)] + ["http://new.one.com/1", "http://rare.two.com/1"]
    bad = [(i, 1) for i in range(60)] + [(i, 0) for i in range(60, 120)] + [(121, 1), (5000, 1), (3, None)]
    got = judged(spark, urls, bad)
    assert got[0].verdict == "block" and got[60].verdict == "allow"
    assert got[121].verdict == "allow"  # a single bad page of a good domain
    assert got[120].host_bound is None and got[120].verdict == "allow"


def test_levels(spark):
    hosts = ["a.b.example.com", "x.co.uk", "w.x.co.uk", "localhost", "10.0.0.1", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = uf.levels(df["host"])
    assert [tuple(r) for r in df.select(domain, suffix).collect()] == [
        ("example.com", "com"), ("x.co.uk", "co.uk"), ("x.co.uk", "co.uk"), ("localhost", "localhost"), ("10.0.0.1", "10.0.0.1"), ("", "")]


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for t in ("pages", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = db.sql(uf.ORACLE_SQL["op8_url_filter"])
    got = uf.op8_url_filter(spark, folder).select(*want.columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)
