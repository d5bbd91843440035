import random

from pyspark.sql import functions as F

from korpusmill.llm import queries
from korpusmill.llm.url_filter import canonical, filter_urls

URLS = [
    None, "", "no scheme", "http://", "http://COM/x", "http://com", "https://www.Example.com/en/a?b#c", "http://example.com/en/1",
    "http://notexample.com/en/1", "http://sub.example.com/en/1", "http://sub.www.example.com/en/1", "http://a.net/es/x", "http://net/fr/",
    "http://a.net/en/?utm_source=x&p=1&ref=y#f", "ftp://a.org/Ä://b", "http://ÄA.org/x/", "http://a.org:80/x///", "x://a.com/\nen/", "http://spam-farm.org/q",
    "http://a.org?x://b/c", "http://a.org#f/", "http://ICOM/", "http://www.org/" + "y" * 100_000,
]


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = []
    for rule, _ in queries.URL_RULES:
        name, _, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
            fits.append(rule)
    return host, path, max(fits, key=len) if fits else None


def test_every_url_gets_host_path_and_longest_rule(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) * 2, "page_id bigint, url string").withColumn("rule", F.lit("clash"))
    listed = spark.createDataFrame([("a.net/en",), (None,), ("a.org/x",), ("a.org/x",)], "canonical string")
    rows = filter_urls(pages, listed, queries.URL_RULES).collect()
    assert len(rows) == 2 * len(URLS)
    says = dict(queries.URL_RULES)
    forms = dict(pages.select("page_id", canonical(F.col("url")).alias("c")).collect())
    for r in rows:
        host, path, rule = expected(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), URLS[r["page_id"]]
        assert r["verdict"] == (says[rule] if rule else "block" if forms[r["page_id"]] in ("a.net/en", "a.org/x") else "allow")
    assert forms[13] == "a.net/en/?p=1".replace("/?", "?") and forms[16] == "a.org/x"


def test_filter_passes_all_listed_urls_and_few_others(spark):
    rng = random.Random(5)
    names = [f"h{rng.randrange(10**9)}.org/{i}" for i in range(6000)]
    pages = spark.createDataFrame([(i, "http://" + n) for i, n in enumerate(names)], "page_id bigint, url string")
    listed = spark.createDataFrame([(n,) for n in names[:2000]], "canonical string")
    rows = filter_urls(pages, listed, ()).collect()
    assert all(r["possible"] and r["verdict"] == "block" for r in rows if r["page_id"] < 2000)
    others = [r for r in rows if r["page_id"] >= 2000]
    assert all(r["verdict"] == "allow" for r in others) and sum(r["possible"] for r in others) < 0.02 * len(others)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    listed = spark.createDataFrame([], "canonical string")
    assert filter_urls(pages, listed, queries.URL_RULES).collect() == []
    one = spark.createDataFrame([(None, "http://a.org/")], "page_id bigint, url string")
    assert [tuple(r) for r in filter_urls(one, listed, ()).collect()] == [(None, "a.org", "/", None, "allow", False)]
