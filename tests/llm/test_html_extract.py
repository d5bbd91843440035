import time

import pytest

from korpusmill.llm.html_extract import extract_main_text, main_lines, main_text

ARTICLE = """<!doctype html><html><head><title>Site</title><style>p{}</style><script>var a="<article>no</article>";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><a href="/">Home</a></nav><div id="cookieNotice"><p>We use cookies.</p></div>
<article><header><h1>Head &amp; line</h1></header><p>First  part<br>goes\n on<b>ward</b>.</p><!-- <p>no</p> --><div class="ad"><p>Buy this</p></div>
<p>Short.<p>Left open &lt;tag&gt; &#233;&nbsp;x<ul><li>one<li>two</ul><form><p>Subscribe</p></form>
<table><tr><td>a</td><td>b</td></tr></table><section id="comments"><h2>Comments</h2><article class="comment"><p>Nice</p></article></section></article>
<aside>Related</aside><div class="sidebar widget">Popular</div><footer>&copy; 2024</footer></body></html>"""
EXPECTED = "Head & line\n\nFirst part goes onward.\n\nShort.\n\nLeft open <tag> é x\n\none\n\ntwo\n\na\n\nb"


def test_article_without_the_rest():
    assert main_text(ARTICLE) == EXPECTED
    assert main_text(ARTICLE.replace("<article>", "<main>", 1).replace("</article>\n<aside>", "</main>\n<aside>")) == EXPECTED


def test_page_without_marks_is_cut_by_its_lines():
    long = "Words enough to make the sums of lengths surge, as those of running text do in any page of news. " * 2
    page = f"""<body><div>Home</div><div><a href=a>One</a> <a href=b>Two</a></div><div><a href=c>Three</a></div><div><a href=d>Four</a></div>
    <div><a href=e>Five</a></div><h1>Title</h1><p>{long}</p><p>{long}<a href=x>link</a></p><div class="share-buttons">Share</div><p>End.</p>
    <div><a href=f>Six</a></div><div><a href=f>Seven</a></div><div><a href=f>Eight</a></div><div>&copy; Site</div></body>"""
    assert main_text(page) == f"Title\n\n{long.strip()}\n\n{long}link\n\nEnd."


def test_page_without_marks_keeps_headline_and_both_sides_of_a_list_of_links():
    long = "Words enough to make the sums of lengths surge, as those of running text do in any page of news."
    links = "".join(f"<div><a href={i}>Read story number {i}</a></div>" for i in range(5))
    page = f"""<body><div>Home</div>{links}<h1>A headline of the day</h1><div>By A. Writer</div><div>1 May 2024</div><p>Short lead.</p><p>{long}</p><p>{long} {long}</p>
    {links}<h2>Second part</h2><p>Also short.</p><p>So is this.</p><p>{long}</p>{links}<div>&copy; Site</div></body>"""
    head = ["A headline of the day", "By A. Writer", "1 May 2024", "Short lead.", long, f"{long} {long}"]
    assert main_text(page).split("\n\n") == [*head, "Second part", "Also short.", "So is this.", long]
    assert main_text(page.replace("By A. Writer", "<a href=w>By A. Writer</a>")).split("\n\n") == [*head[:1], *head[2:], "Second part", "Also short.", "So is this.", long]


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a", "a"), ("a < b", "a < b"), ("<article><p>x", "x"), ("<p>a<!-- open", "a"), ("<script>x", ""),
    ("<article>a<div hidden>b</div><div role='navigation'>c</div><p aria-hidden=true>d</p>e</article>", "a\n\ne"), ("</p></div>x", "x"), ("x<", "x<"),
    ("<article><p>a&amp;b &amp c &unknown; &#x41;</p></article>", "a&b & c &unknown; A"), ("<ARTICLE><P CLASS=\"a>b\">x</P></ARTICLE>y", "x"),
    ("<article> \n</article>", ""),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("piece", ["<a ", "<p class='x", "<!--", '<div><a href="', "<script>", "<li>", "</div", "<p><b>", "<nav>", "<![", "<a '>\">", "<style></styl", "<div>"])
def test_time_is_linear_in_broken_markup(piece):
    start = time.perf_counter()
    main_text(piece * 100_000)
    assert time.perf_counter() - start < 6


def test_every_row_gives_a_row(spark):
    rows = [(1, "u", ARTICLE, 5), (1, "u", ARTICLE, 5), (None, None, None, 5), (2, "v", "", 5), (3, "w", "<article>" + "<p>word</p>" * 50_000 + "</article>", 5)]
    out = extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int"))
    assert out.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    got = sorted(map(tuple, out.collect()), key=repr)
    want = [(i, u, main_text(h), len(main_text(h))) for i, u, h, _ in rows]
    assert got == sorted(want, key=repr)
    assert extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


P = "Words enough to make the sums of lengths surge, as those of running text do in any page of news, and in stories of some length."
STORY = "".join(f"<p>{k}. {P}</p>" for k in range(5))
TOLD = [f"{k}. {P}" for k in range(5)]


def test_a_small_article_does_not_hide_the_story():
    teaser = "<article><h3>Teaser</h3><p>Read next</p></article>"
    assert main_text(f"<body><main><h1>Headline</h1>{STORY}{teaser}</main></body>").split("\n\n")[:6] == ["Headline", *TOLD]
    assert main_text(f"<body><h1>Headline</h1>{STORY}{teaser}</body>").split("\n\n")[:6] == ["Headline", *TOLD]
    assert main_text(f"<body>{teaser}<div>{STORY}</div>{teaser}</body>").split("\n\n") == TOLD


@pytest.mark.parametrize("name", ["social-policy", "search", "notice", "comment", "promotion", "ad", "legal", "tags", "toc", "search-results", "LegalAdvice", "story related"])
def test_a_noisy_name_on_the_story_weighs_but_does_not_decide(name):
    for page in (f'<article class="{name}">{STORY}</article>', f'<body><div id="{name}">{STORY}</div><div>Short</div></body>', f'<main class="{name}">{STORY}</main><article><p>Read next</p></article>'):
        assert [t for t in main_text(page).split("\n\n") if t in TOLD] == TOLD


def test_noisy_names_silence_beside_a_story():
    comments = "".join(f'<article class="comment"><p>{P} {P}</p></article>' for _ in range(20))
    page = f'''<body><article><h1>Headline</h1>{STORY}<div class="ad-box"><p>{P}</p></div><div class="breaking-promo"><p>Buy</p></div></article>
    <section class="comments">{comments}</section><div class="cookie-notice">{P}</div><div class="related-posts">{P}</div></body>'''
    assert main_text(page).split("\n\n") == ["Headline", *TOLD]


def test_windows_surges_and_dives_choose_on_marked_pages():
    links = "".join(f"<li><a href={i}>Read story number {i}</a></li>" for i in range(6))
    page = f"<body><article><h1>Headline</h1>{STORY}<ul>{links}</ul>{STORY}<p>Note</p></article><div>{P}</div></body>"
    assert main_text(page).split("\n\n") == ["Headline", *TOLD, *TOLD, "Note"]  # the list is a dive, the notice outside a light run
    assert main_text(page.replace(links, links[: links.index("</li>") + 5])).split("\n\n")[6] == "Read story number 0"  # one link is none
    lines = [("Headline", 0, 2), *((t, 0, 2) for t in TOLD), *[("link", 4, 2)] * 3, ("Note", 0, 2), (P, 0, 0)]
    assert main_lines(lines) == ["Headline", *TOLD]  # no surge after the dive
    assert main_lines(lines, window=4)[-1] == "Note" and main_lines(lines, surge=16)[-1] == "Note"


def test_an_article_of_links_alone_counts_whole():
    assert main_text("<article><p><a href=a>One</a></p><p><a href=b>Two</a></p></article>") == "One\n\nTwo"


def test_deep_noisy_names_are_linear():
    start = time.perf_counter()
    main_text('<div class="ad">x' * 100_000)
    assert time.perf_counter() - start < 6
