"""The cascade's verdicts against the rules read plainly, and against the SQL."""

import re

import duckdb

from tidemark.llm import url_cascade as op
from tidemark.llm.queries import ORACLE, QUERIES

PAGES = "page_id long, url string, host string, verdict string"
URLS = [None, "", "no scheme/en/", "://", "http://", "http://net", "http://net/", "http://NET/?x", "http://a.net/en/", "http://example.net",
        "http://example.net/en", "http://example.net/en/", "http://WWW.Example.Net/en/1?q=/de/", "https://x.example.com/de/7#t",
        "http://example.com/en/", "http://badexample.com/de/", "http://a.org/fr/2", "http://org/fr/", "http://a.org/fr",
        "http://a.org?/fr/", "http://a.org#/fr/", "http://é.net/É/", "http://a..net//", "http://.net/", "http://net:80/", "x://y://a.net/",
        "http://a.net/" + "b/" * 3000, "http://a.net/", "http://a.net/"]


def plain(url, rules=op.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for key, action in rules:
        h, _, p = key.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(key) > len(best[0])):
            best = (key, action)
    return host, path, best and best[0], best[1] if best else "allow"


def test_equals_the_rules(spark):
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)] + [(None, "http://a.net/", "h", "v")], PAGES)
    got = op.judge(df).collect()
    expected = [(str(i), *map(str, plain(u))) for i, u in [*enumerate(URLS), (None, "http://a.net/")]]
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted(expected)


def test_many_rules_over_many_keys(spark):
    rules = tuple((f"h{i}.example/", "block" if i % 3 else "allow") for i in range(0, 3000, 7)) + (("example/a/", "block"),)
    urls = [f"http://h{i}.example/{'a/' * (i % 2)}x" for i in range(3000)]
    got = op.judge(spark.createDataFrame([(i, u, "", "") for i, u in enumerate(urls)], PAGES), rules).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in got} == {(i, *plain(u, rules)[2:]) for i, u in enumerate(urls)}


def test_levels_shrink(spark):
    keys = spark.range(20000).selectExpr("concat('k', id) as key")
    listed = keys.where("key like '%77'")
    cascade = op.build(listed, keys)
    from pyspark.sql import functions as F
    wrong = keys.where(cascade.contains(F.col("key")) != F.col("key").like("%77")).count()
    assert wrong == 0 and len(cascade.levels) > 1
    assert sum(level.bits for level in cascade.levels) < 200 * 30


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    res = con.execute(ORACLE["op4_url_cascade"])
    cols = [d[0] for d in res.description]
    expected = sorted(str(dict(zip(cols, r))) for r in res.fetchall())
    got = QUERIES["op4_url_cascade"](spark, sf)
    assert sorted(str({c: r[c] for c in cols}) for r in got.collect()) == expected


def test_empty(spark):
    assert op.judge(spark.createDataFrame([], PAGES)).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/", "", "")], PAGES)
    assert op.judge(one, ()).first().verdict == "allow"
