from pyspark.sql import functions as F

from roadpulse.llm import urls
from roadpulse.llm.bloom import possible
from roadpulse.llm.queries import RULES

URLS = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://EXAMPLE.ORG/es/1", "http://a.example.org/en/1", "http://a.example.org/en/19?x#y", "http://example.org/en/2", "http://org", "http://org/",
    "http://b.com/fr/1", "http://b.com/de/x", "http://b.com/DE/x", "http://xcom/de/", "https://www.Bad.net/page/", "bad.net/page", "ftp://bad.net/page?q=1#f", "http://bad.net:80/page", "http://bad.net/page2",
    "http://x?y://z", "a://b://c/d", "http://.org/", "http://example.org./es/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def judged(url, listed):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits)[2:])
    spelled = lambda h, p: h.removeprefix("www.").removesuffix(":80").removesuffix(":443") + p.rstrip("/")
    return host, path, None, "block" if url is not None and spelled(host, path) in {spelled(*parts(u)) for u in listed} else "allow"


def test_verdicts_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS * 2)], "page_id int, url string, Verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = ["http://bad.net/page", "https://other.net/"]
    found = urls.judge(pages, rules, spark.createDataFrame([(u,) for u in [*listed, None]], "url string"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    assert len(got) == len(URLS) * 2
    for i, u in enumerate(URLS * 2):
        assert got[i] == judged(u, listed), u
    none = spark.createDataFrame([], "url string")
    assert urls.judge(pages.limit(0), rules, none).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0), none).collect()} == {"allow"}


def test_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("key"))
    kept = {r["key"] for r in possible(rows, "key", keys, 2000).collect()}
    assert {f"k{i}" for i in range(2000)} <= kept and len(kept) < 2000 + 0.02 * 38_000
    assert possible(rows, "key", keys.limit(0), 0).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id int, url string")
    rules = spark.sql("select 'org' host, '/' path, 'allow' verdict")
    plan = urls.judge(pages, rules, pages.select("url"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
