import re
import uuid

import pytest

from korpusmill.operators.crawl import bucketed, crawl_accounts, discover, next_level
from korpusmill.profiles import EN, RU
from korpusmill.session import shared_folder

HOST = "https://x.org"


def pages_of(spark, links):
    html = lambda to: "".join(f'<a href="/r/{t}">n</a>' for t in to)
    return spark.createDataFrame([(i, f"{HOST}/r/{p}" if p else f"{HOST}/r", html(to)) for i, (p, to) in enumerate(links.items())], "page_id bigint, url string, html string")


def plain_levels(links):
    seen, level, n = {"": 0}, [""], 0
    while level:
        n += 1
        found = {t for p in level for t in links.get(p, ())} - seen.keys()
        seen |= dict.fromkeys(found, n)
        level = sorted(found)
    return {(f"{HOST}/r/{p}" if p else f"{HOST}/r", k) for p, k in seen.items()}


def levels(spark, links, profile=RU):
    roots = spark.createDataFrame([(f"{HOST}/r/",)], "root_url string")
    return {(r["url"], r["level"]) for r in discover(pages_of(spark, links), roots, profile).collect()}


def test_chain(spark):
    links = {"": ["p1"]} | {f"p{i}": [f"p{i + 1}", f"p{i - 1}", f"p{i // 2}"] for i in range(1, 40)}
    assert levels(spark, links) == plain_levels(links)


def test_hub(spark):
    links = {"": ["hub"], "hub": [f"q{i}" for i in range(1500)]} | {f"q{i}": ["hub", f"q{i * 7 % 1500}", "last"] for i in range(1500)}
    assert levels(spark, links) == plain_levels(links)


def test_fetched_pages_alone_lead_on(spark):
    links = {"": ["a", "gone"], "a": ["b"], "b": [], "c": []}
    assert {u for u, _ in levels(spark, links, EN)} == {f"{HOST}/r", f"{HOST}/r/a", f"{HOST}/r/b"}


@pytest.mark.parametrize("profile", [EN, RU])
def test_accounts_add_up(spark, profile):
    links = {"": ["a", "b", "a"], "a": ["b", "c", "gone", ""], "b": ["c", "gone", "a"], "c": ["d", "a"], "d": ["c", "gone"], "far": ["a"]}
    pages = pages_of(spark, links).unionByName(spark.createDataFrame([(99, f"{HOST}/r/gone", None), (98, f"{HOST}/r/a/?x=1", "<a href='/r/b'>n</a>")], "page_id bigint, url string, html string"))
    roots = spark.createDataFrame([(f"{HOST}/r",), (f"{HOST}/r/far",), (f"{HOST}/nothing",)], "root_url string")
    got = {r["root_url"].removeprefix(HOST): tuple(r)[1:] for r in crawl_accounts(pages, roots, profile).collect()}
    order = {u.removeprefix(f"{HOST}/r").strip("/"): (k, u) for u, k in plain_levels({p: [t for t in to if t] for p, to in links.items()})}
    repeats = sum(order[t] > order[p] for p, to in links.items() if p in order for t in set(to) if t in order)
    assert got["/r"] == (6, 5, repeats, 1, 5) and repeats > 5
    assert got["/r/far"] == (1, 0, 0, 0, 1) and got["/nothing"] == (1, 0, 0, 1, 0)


def test_no_roots_and_no_pages(spark):
    empty = pages_of(spark, {"": []}).limit(0)
    none = spark.createDataFrame([], "root_url string")
    assert discover(empty, none, RU).collect() == []
    roots = spark.createDataFrame([(f"{HOST}/r/a.pdf",), (f"{HOST}/r",), (f"{HOST}/r",)], "root_url string")
    assert [tuple(r) for r in discover(empty, roots, RU).collect()] == [(f"{HOST}/r", f"{HOST}/r", 0)]


def test_tables_are_dropped(spark):
    levels(spark, {"": ["a"]})
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("crawl_")] == []


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_level_shuffles_neither_links_nor_visited(spark, no_broadcast, capsys):
    name, home = f"crawl_{uuid.uuid4().hex}", shared_folder(spark, "crawl-plan")
    links = bucketed(spark.createDataFrame([("a", "b", "/b")], "url string, link string, link_scope string"), f"{name}_links", f"{home}/links", "url")
    rows = spark.createDataFrame([("r", "a", "/", 0)], "root_url string, url string, root_scope string, level int")
    visited = bucketed(rows, f"{name}_visited", f"{home}/visited", "root_url", "url", partition="level")
    found = next_level(visited.where("level = 0"), links, visited)
    assert [tuple(r) for r in found.collect()] == [("r", "b", "/")]
    found.explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[-1]
    # The frontier to the links' buckets, what it found to the visited ones'.
    assert len(re.findall(r"Exchange hashpartitioning\(url", plan)) == 1 and len(re.findall("Exchange hashpartitioning", plan)) == 2, plan
    assert plan.count("Bucketed: true") >= 2
    for t in ("links", "visited"):
        spark.sql(f"DROP TABLE {name}_{t}")
