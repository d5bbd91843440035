import html
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from korpusmill.functions import html as H
from korpusmill.operators import webdocs
from korpusmill.profiles import EN, KG, RU


def test_unescape_agrees_with_the_standard_library(apply):
    values = ["plain", "a &amp; b", "&lt;&gt;&quot;&apos;", "&#1179;&#x4AF;", "&nbsp;|&mdash;|&copy;", "AT&T", "&amp;lt;", "&unknown;", "&", "&#150;", "&#0;", "&#xD800;", "&copy 1", "&laquo;текст&raquo;",
        "&#0000000065;", "&#x00000000041;x", "&copyright", "&notit;", "&ampamp;", "&#99999999999;", "&#xFFFFFFFFFF", "&#1114112;", "&#129;&#x9d;",
        "&#1;&#xB;&#127;&#xFDD0;&#65535;&#x1FFFE;|", "&#13;", "&#x;", "&#;", "&frac12x", "&fracx", "&CounterClockwiseContourIntegral;", "a&lt", "&GTx;", "&#32x"]
    assert apply(H.unescape, values) == [html.unescape(v) for v in values]


def test_names_are_in_the_plan_once(spark):
    plan = spark.range(1).select(H.unescape(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("keys:") == 1


@pytest.mark.parametrize("piece", [
    "<a ", "<a x>", "<h1>", "<h1 ", "<title>", "<p>", "<script>", "<script ", "<style>", "<!--", "<nav>", "<footer ", "<li>", "<div class=x>", "</h1", "<head>",
    '<nav aria-label="breadcrumb">', '<ul class="breadcrumb">', "&", "&#", "&a",
])
def test_time_is_linear_in_markup_without_ends(spark, piece):
    page = spark.createDataFrame([(1, "https://h.example.org/", piece * 100_000)], "page_id bigint, url string, html string")
    start = time.perf_counter()
    webdocs.page_records(page, EN).collect()
    webdocs.page_links(page, RU).collect()
    assert time.perf_counter() - start < 30


def test_title(apply):
    pages = [
        "<title>T</title><h1 class='a'>Main <b>one</b></h1><h1>two</h1>", "<title> A &amp; B </title><h1> </h1><h1>second</h1>",
        "<p>none</p>", "<!-- <h1>no</h1> --><h1>yes</h1>", "<script>'<h1>no</h1>'</script><title>x</title>",
    ]
    assert apply(lambda c: H.extract_title(H.drop_hidden(c)), pages) == ["Main one", "A & B", None, "yes", "x"]


def test_breadcrumbs(apply):
    pages = [
        '<nav aria-label="Breadcrumb"><a href="/">Home</a> <span>Tariffs</span><a>Home</a></nav><ul class="breadcrumb"><li>no</li></ul>',
        '<nav class="x" aria-label="page breadcrumbs"></nav><ul class="breadcrumb"><li>no</li></ul>',
        '<ul class="list breadcrumb-list"><li><a>Один</a></li><li> Два </li><li></li></ul>',
        '<nav aria-label="breadcrumb"><a><span>In</span></a></nav>', "<nav><a>x</a></nav>",
    ]
    assert apply(H.extract_breadcrumbs, pages) == [["Home", "Tariffs"], [], ["Один", "Два"], ["In"], []]


def links(spark, markup, **more):
    df = spark.createDataFrame([(1, "https://h.kg/a/b", markup)], "page_id int, url string, html string")
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return webdocs.page_links(df, RU).first().links


def test_links(spark):
    markup = """<a href="x?q=1">1</a><a class=c href='/y/'>2</a><a href=z>3</a><a href=" ">4</a><a name=n>5</a>
    <a href="doc.pdf">6</a><a href="mailto:a@b.c">7</a><a href="x#2">8</a><!-- <a href="/no">9</a> --><a title="a>b" href="/t">10</a>
    <a data-href="/no2">11</a><abbr href="/no3">12</abbr><a href="/q?a=1&amp;b=2">13</a>"""
    assert links(spark, markup) == [
        "https://h.kg/a/x", "https://h.kg/y", "https://h.kg/a/z", "mailto:a@b.c", "https://h.kg/t", "https://h.kg/q",
    ]


def test_rendered_links_count_only_where_plain_ones_are_few(spark):
    many = "".join(f'<a href="/{i}">x</a>' for i in range(8))
    assert links(spark, '<a href="/1">x</a>', js_html='<a href="/1">x</a><a href="/js">y</a>') == ["https://h.kg/1", "https://h.kg/js"]
    assert len(links(spark, many, js_html='<a href="/js">y</a>')) == 8


def cleaned(spark, markup, profile):
    df = spark.createDataFrame([(markup,)], "html string")
    row = webdocs.with_clean_markup(df, profile).select(H.markup_text(F.col("cleaned"))).first()
    return row[0]


def test_layout_elements(spark):
    markup = "<header>h</header><nav>n</nav><p>text</p><script>s</script><footer>f</footer>"
    assert cleaned(spark, markup, RU) == "text"
    assert cleaned(spark, markup, EN) == "h n text f"
    assert cleaned(spark, "<aside>a<aside>b</aside>c</aside><p>text</p>", RU) == "text"
    assert cleaned(spark, "<p>text</p><nav>never closed", RU) == "text"


def test_noise_by_class_or_id(spark):
    small = replace(RU, noise_max_chars=20)
    long = "word " * 10
    assert cleaned(spark, '<div id="Cookie-bar">c<div>d</div></div><p>text</p>', small) == "text"
    assert cleaned(spark, f'<div class="modal"><p>{long}</p><i class="share">s</i></div>', small) == long.strip()
    assert cleaned(spark, '<div class="политика">п</div>t', small) == "t"
    # The word counts within class or id only, and unwanted elements do not add to the length.
    assert cleaned(spark, '<div title="cookie">c</div>', small) == "c"
    assert cleaned(spark, f'<div class="popup">x<script>{long}</script></div>t', small) == "t"


def test_interactive(spark):
    pages = {
        '<button aria-expanded="false">x</button>': True, '<a data-bs-toggle="collapse">x</a>': True, '<div class="my faq">x</div>': True,
        '<div class="faqs">x</div>': False, "<p>Подробнее</p>": True, "<p>МЕНЮ</p>": False, '<p title="more">x</p>': False,
        "<!-- read --><p>x</p>": True,
    }
    df = spark.createDataFrame([(k,) for k in pages], "html string")
    got = {r[0]: r[1] for r in df.select("html", H.page_looks_interactive(F.col("html"), RU)).collect()}
    assert got == pages
    kyrgyz = spark.createDataFrame([("<p>Көбүрөөк</p>",)], "html string")
    assert kyrgyz.select(H.page_looks_interactive(F.col("html"), KG), H.page_looks_interactive(F.col("html"), RU)).first()[:] == (True, False)


def test_main_text_skips_link_blocks_and_falls_back(spark):
    pages = [
        ("<head><title>T</title></head><ul><li><a href=x>menu entry</a></li></ul><p>A paragraph of the page itself.</p>",),
        ("<ul><li><a href=x>only</a></li><li><a href=y>links</a></li></ul>",),
        ("",),
    ]
    df = H.with_main_text(spark.createDataFrame(pages, "cleaned string"), "cleaned", "text")
    assert [r.text for r in df.collect()] == ["A paragraph of the page itself.", "only links", ""]


def test_page_records(spark):
    body = "<h1>T</h1><p>" + "слово " * 30 + "</p>"
    rows = [(1, "https://h.kg/a/", body, "https://h.kg/b/", "short"), (2, "https://h.kg/c", "<p>x</p>", None, "longer text"), (3, "https://h.kg/d", None, None, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, final_url string, js_text string")
    got = {r.ordinal: r for r in webdocs.page_records(df, RU).collect()}
    assert set(got) == {1, 2}
    assert got[1].url == "https://h.kg/b" and got[1].title == "T" and got[1].content_text.startswith("T слово")
    assert got[2].content_text == "longer text" and got[2].about == "longer text"


def test_dedupe_keeps_first_or_last(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "a", "z")], "ordinal int, url string, t string")
    first = {(r.url, r.ordinal, r.t) for r in webdocs.dedupe_by_url(df, "first").collect()}
    last = {(r.url, r.ordinal, r.t) for r in webdocs.dedupe_by_url(df, "last").collect()}
    assert first == {("a", 1, "x"), ("b", 2, "y")}
    assert last == {("a", 1, "z"), ("b", 2, "y")}
