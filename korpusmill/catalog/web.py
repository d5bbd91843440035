"""Registered queries on page extraction, web documents and crawling."""

from __future__ import annotations

from pyspark.sql import functions as F

from korpusmill.catalog import inputs as I
from korpusmill.catalog import sql as q
from korpusmill.functions import html as H
from korpusmill.functions.url import canonical_url, category_name
from korpusmill.operators import crawl, webdocs
from korpusmill.plans.web_corpus import collect_site
from korpusmill.profiles import EN, KG, RU
from korpusmill.session import shared_folder
from korpusmill.streaming import web_stream

QUERIES, ORACLES = {}, {}


def _register(name, query, oracle=None):
    QUERIES[name] = query
    if oracle:
        ORACLES[name] = oracle


def _pages(spark, d):
    return I.table(spark, d, "pages")


def _tidy(c):
    return F.concat_ws("|", c)


def _sql_title(x: str) -> str:
    visible = q.drop(x, "script", "style")
    h1 = q.markup_text(q.group(visible, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1))
    title = q.norm_space(q.unescape(q.group(visible, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))
    return f"coalesce(nullif({h1}, ''), nullif({title}, ''))"


_LINKS = r"""hrefs AS (SELECT page_id, url, unnest(regexp_extract_all({html}, '(?is)<a\s[^>]*?href="([^"]*)"', 1)) AS h FROM {table}),
links AS (SELECT DISTINCT page_id, {base} AS page, regexp_extract({base}, '^[a-z]+://[^/]*') || regexp_replace(h, '(.)/$', '\1') AS link FROM hrefs WHERE h LIKE '/%')"""
_SQL_LINKS = _LINKS.format(html=q.drop("html", "script", "style"), table="pages", base=q.canonical("url"))
_MAIN_TAGS = RU.drop_tags

_BLOCKS = (
    r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|table|thead|tbody|tr|td|th|section|article|main|blockquote|pre|dl|dt|dd|"
    r"form|fieldset|figure|figcaption|body|html|br|hr|details|summary|header|footer|nav|aside|address)\b[^>]*>"
)


def _sql_main(cleaned: str) -> str:
    """``b``: blocks with own text and link text lengths, as a list per page."""
    body = q.drop(cleaned, "head")
    plain = q.norm_space(q.sub("x", q.TAG))
    linked = q.norm_space(q.sub(r"array_to_string(regexp_extract_all(x, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1), ' ')", q.TAG))
    return (
        f"list_transform(regexp_split_to_array({body}, {q.quote(_BLOCKS)}), "
        f"lambda x: {{'t': {plain}, 'l': length({linked})}})"
    )


def _sql_pass(min_chars: int, share: float) -> str:
    return (
        f"array_to_string(list_transform(list_filter(b, lambda x: length(x.t) >= {min_chars} "
        f"AND x.l <= length(x.t) * {share}::DOUBLE), lambda x: x.t), ' ')"
    )


def _sql_texts(source: str, tags: tuple[str, ...]) -> str:
    cleaned = q.drop("html", *tags)
    best = q.norm_space(q.unescape("CASE WHEN length(s2) >= length(s1) THEN s2 ELSE s1 END"))
    return f"""blocks AS (SELECT page_id, url, html, {_sql_main(cleaned)} AS b FROM {source}),
    passes AS (SELECT page_id, url, html, {_sql_pass(25, 0.33)} AS s1, {_sql_pass(1, 0.66)} AS s2 FROM blocks),
    texts AS (SELECT page_id, url, html, coalesce(nullif({best}, ''), {q.markup_text(cleaned)}) AS t FROM passes)"""


_register(
    "page_titles",
    lambda spark, d: _pages(spark, d).select("page_id", H.extract_title(H.drop_hidden(F.col("html"))).alias("title")),
    f"SELECT page_id, {_sql_title('html')} AS title FROM pages",
)
_register(
    "page_breadcrumbs",
    lambda spark, d: I.rich_pages(spark, d).select(
        "page_id", _tidy(H.extract_breadcrumbs(H.drop_hidden(F.col("html")))).alias("breadcrumbs")
    ),
    f"""WITH {I.RICH}, v AS (SELECT page_id, {q.drop('html', 'script', 'style')} AS html FROM rich),
    n AS (SELECT page_id, CASE page_id % 4
      WHEN 0 THEN regexp_extract_all(regexp_extract(html, '(?is)<nav aria-label="Breadcrumb">(.*?)</nav>', 1), '(?is)<a\\b[^>]*>(.*?)</a>', 1)
      WHEN 1 THEN regexp_extract_all(regexp_extract(html, '(?is)<ul class=.main breadcrumbs.>(.*?)</ul>', 1), '(?is)<li\\b[^>]*>(.*?)</li>', 1)
      ELSE [] END AS l FROM v),
    e AS (SELECT page_id, i, {q.markup_text('l[i]')} AS t FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM n)),
    f AS (SELECT page_id, t, min(i) AS i FROM e WHERE t <> '' GROUP BY page_id, t),
    g AS (SELECT page_id, string_agg(t, '|' ORDER BY i) AS b FROM f GROUP BY page_id)
    SELECT page_id, coalesce(b, '') AS breadcrumbs FROM rich LEFT JOIN g USING (page_id)""",
)
_register(
    "page_links",
    lambda spark, d: webdocs.page_links(_pages(spark, d), RU).select("url", F.explode("links").alias("link")),
    f"WITH {_SQL_LINKS} SELECT page AS url, link FROM links",
)
def _with_rendered_links(spark, d):
    """Even pages have a rendered version with one more link and one they have anyway."""
    extra = F.concat(F.lit('<a href="/js/'), F.col("page_id").cast("string"), F.lit('">m</a>'))
    first = F.regexp_extract("html", '<a href="/[^"]*">', 0)
    js = F.when(F.col("page_id") % 2 == 0, F.concat(first, F.lit("x</a>"), extra))
    return _pages(spark, d).withColumn("js_html", js)


_register(
    "rendered_links",
    lambda spark, d: webdocs.page_links(_with_rendered_links(spark, d), RU).select("url", F.explode_outer("links").alias("link")),
    rf"""WITH {_SQL_LINKS}, counted AS (SELECT page_id, count(*) AS n FROM links GROUP BY page_id)
    SELECT page AS url, link FROM links UNION ALL
    SELECT {q.canonical('url')}, regexp_extract({q.canonical('url')}, '^[a-z]+://[^/]*') || '/js/' || page_id
    FROM pages LEFT JOIN counted USING (page_id) WHERE page_id % 2 = 0 AND coalesce(n, 0) < 8""",
)
_register(
    "page_text_fallback",
    lambda spark, d: _pages(spark, d).select(
        "page_id", H.markup_text(H.drop_elements(F.col("html"), RU.drop_tags)).alias("text")
    ),
    f"SELECT page_id, {q.markup_text(q.drop('html', *RU.drop_tags))} AS text FROM pages",
)
_register(
    "page_main_text",
    lambda spark, d: H.with_main_text(webdocs.with_clean_markup(_pages(spark, d), EN), "cleaned", "text").select("page_id", "text"),
    f"WITH {_sql_texts('pages', EN.drop_tags)} SELECT page_id, t AS text FROM texts",
)
_register(
    "clean_markup",
    lambda spark, d: webdocs.with_clean_markup(I.rich_pages(spark, d), RU).select(
        "page_id", H.markup_text(F.col("cleaned")).alias("text")
    ),
    f"""WITH {I.RICH}, c AS (SELECT page_id, {q.sub(q.drop('html', *RU.drop_tags), '(?s)<div class="cookie-banner">.*?</div>')} AS html FROM rich)
    SELECT page_id, {q.markup_text('html')} AS text FROM c""",
)
_WORDS = "|".join(RU.interactive_words)
_register(
    "interactive_pages",
    lambda spark, d: I.rich_pages(spark, d).select("page_id", H.page_looks_interactive(F.col("html"), RU).alias("interactive")),
    f"""WITH {I.RICH} SELECT page_id, page_id % 4 IN (2, 3) OR
    {q.has(q.sub('html', '<[A-Za-z/](?:[^' + chr(34) + "'>]|" + chr(34) + '[^' + chr(34) + ']*' + chr(34) + "|'[^']*'|[" + chr(34) + "'])*>"), '(?i)' + _WORDS)} AS interactive FROM rich""",
)


def _with_rendered(spark, d):
    """Every third page also has a rendered text, longer or shorter than its own."""
    pages = _pages(spark, d)
    js = F.when(F.col("page_id") % 3 == 0, F.concat_ws(" ", *[F.col("url")] * 40)).when(F.col("page_id") % 3 == 1, F.lit("short"))
    return pages.withColumn("js_text", js)


_register(
    "rendered_fallback",
    lambda spark, d: webdocs.page_records(_with_rendered(spark, d), EN).select("ordinal", "url", "content_text", "about"),
    f"""WITH {_sql_texts('pages', EN.drop_tags)},
    j AS (SELECT *, CASE page_id % 3 WHEN 0 THEN rtrim(repeat(url || ' ', 40)) WHEN 1 THEN 'short' ELSE '' END AS js,
     length(t) < {EN.min_http_chars} OR {q.has(q.sub('html', '<[A-Za-z/][^>]*>'), '(?i)' + '|'.join(EN.interactive_words))} AS wants FROM texts),
    c AS (SELECT page_id, url, CASE WHEN wants AND length(js) > length(t) THEN js ELSE t END AS t FROM j)
    SELECT page_id AS ordinal, {q.canonical('url', False)} AS url, t AS content_text,
     CASE WHEN t <> '' THEN left(t, 280) || CASE WHEN length(t) > 280 THEN '…' ELSE '' END END AS about FROM c""",
)


def _documents(spark, d, profile=RU):
    records = webdocs.dedupe_by_url(webdocs.page_records(_pages(spark, d), profile), profile.duplicate_keep)
    docs = webdocs.web_documents(records, F.lit("https://o.example/"), F.lit("all"), F.lit("en"), profile)
    return docs.withColumn("subcategory_path", _tidy("subcategory_path")).drop("ordinal")


_TRIM_TAIL = "substr(t, CAST(floor(length(t) * 0.7::DOUBLE) AS INTEGER) + 1)"


def _sql_documents(profile, extra: str) -> str:
    from korpusmill.catalog.text import _FOOTER_RE2

    trimmed = "t"
    if profile.trims_footer:
        hit = f"regexp_extract({_TRIM_TAIL}, {q.quote(_FOOTER_RE2)})"
        trimmed = (
            f"CASE WHEN length(t) < 300 OR {hit} = '' THEN t ELSE rtrim(left(t, length(t) - length({_TRIM_TAIL}) "
            f"+ instr({_TRIM_TAIL}, {hit}) - 1)) END"
        )
    u = q.canonical("url", profile.strip_default_ports)
    order = {"first": "ASC", "last": "DESC"}[profile.duplicate_keep]
    return f"""WITH {_sql_texts('pages', profile.drop_tags)},
    r AS (SELECT page_id, {u} AS u, {_sql_title('html')} AS title, {trimmed} AS t FROM texts),
    k AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY page_id {order}) AS n FROM r)
    SELECT u AS source_url, {extra} 'all' AS category,
     array_to_string(list_filter(string_split({q.path('u')}, '/'), lambda s: s <> ''), '|') AS subcategory_path,
     title, CASE WHEN t <> '' THEN left(t, 280) || CASE WHEN length(t) > 280 THEN '…' ELSE '' END END AS about,
     t AS content_text FROM k WHERE n = 1"""


_register("page_documents", lambda spark, d: _documents(spark, d), _sql_documents(RU, ""))
_register(
    "page_documents_en",
    lambda spark, d: _documents(spark, d, EN),
    _sql_documents(EN, "'https://o.example/' AS root_category_url, 'en' AS lang,"),
)


def _visits(spark, d):
    """Many visits per URL: events stand for fetches of a page by their user."""
    events = I.table(spark, d, "events")
    return events.select(
        F.col("event_id").alias("ordinal"),
        canonical_url(F.concat(F.lit("HTTP://O.example//u/"), (F.col("user_id") % 500).cast("string"), F.lit("/?e="), "event_type")).alias("url"),
        "event_type", "value",
    )


_VISITS = "visits AS (SELECT event_id AS ordinal, 'http://o.example/u/' || (user_id % 500) AS url, event_type, value FROM events)"
for _keep, _pick in (("first", "arg_min"), ("last", "arg_max")):
    _register(
        f"url_keep_{_keep}",
        lambda spark, d, keep=_keep: webdocs.dedupe_by_url(_visits(spark, d), keep).withColumn("value", F.round("value", 6)),
        f"""WITH {_VISITS} SELECT url, min(ordinal) AS ordinal, {_pick}(event_type, ordinal) AS event_type,
        round({_pick}(value, ordinal), 6) AS value FROM visits GROUP BY url""",
    )



def _streamed_first(spark, d):
    """Pages by site section, as several batches in an order that is not that of page_id."""
    section = F.regexp_extract("url", r"^[^/]*//[^/]*(/[^/?#]*)?", 0)
    pages = _pages(spark, d).select(F.col("page_id").alias("ordinal"), section.alias("url"), F.md5("html").alias("html_md5"))
    arriving, saved = shared_folder(spark, "arriving"), shared_folder(spark, "saved")
    pages.repartitionByRange(6, F.xxhash64("ordinal")).write.parquet(arriving)
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    web_stream.save_batches(web_stream.first_by_ordinal(stream), saved).awaitTermination()
    return web_stream.read_saved(spark, saved, pages.schema)


_register(
    "stream_keep_first",
    _streamed_first,
    """WITH p AS (SELECT page_id, regexp_extract(url, '^[^/]*//[^/]*(/[^/?#]*)?', 0) AS url, md5(html) AS html_md5 FROM pages)
    SELECT min(page_id) AS ordinal, url, arg_min(html_md5, page_id) AS html_md5 FROM p GROUP BY url""",
)

_register(
    "category_names",
    lambda spark, d: I.rich_pages(spark, d).select(
        "page_id",
        category_name(
            canonical_url(F.col("url")),
            F.when(F.col("page_id") % 5 == 0, F.array(F.lit("Интернет"), F.lit("БАШКЫ"), F.lit("Home")))
            .when(F.col("page_id") % 5 == 1, F.array(F.lit("Home"))),
            F.when(F.col("page_id") % 5 < 3, H.extract_title(F.col("html"))), KG,
        ).alias("category"),
    ),
    f"""SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'Интернет' WHEN page_id % 5 < 3 AND {_sql_title('html')} <> '' THEN {_sql_title('html')}
    ELSE regexp_extract({q.canonical('url')}, '([^/]*)$', 1) END AS category FROM pages""",
)


def _root_presence(spark, d):
    records = _visits(spark, d)
    records = webdocs.dedupe_by_url(records, "first").select("ordinal", "url", "event_type")
    roots = I.table(spark, d, "customer").select(
        F.concat(F.lit("http://o.example/u/"), (F.col("c_custkey") * 3).cast("string")).alias("url"), F.lit("root").alias("event_type")
    )
    return webdocs.prepend_root(records, roots)


_register(
    "prepend_root",
    _root_presence,
    f"""WITH {_VISITS}, r AS (SELECT min(ordinal) AS ordinal, url, arg_min(event_type, ordinal) AS event_type FROM visits GROUP BY url)
    SELECT ordinal, url, event_type FROM r UNION ALL
    SELECT NULL, 'http://o.example/u/' || (c_custkey * 3), 'root' FROM customer WHERE 'http://o.example/u/' || (c_custkey * 3) NOT IN (SELECT url FROM r)""",
)

_SITE = f"""RECURSIVE limits AS (SELECT doc_id % {I.SITES} AS s, max(doc_id // {I.SITES}) AS top FROM documents GROUP BY 1),
reach AS (SELECT s, 0::BIGINT AS m FROM limits UNION SELECT s, t AS m FROM
 (SELECT r.s, unnest([4 * r.m + 1, 4 * r.m + 2, 4 * r.m + 3, 4 * r.m + 4]) AS t FROM reach r JOIN limits l ON r.s = l.s AND r.m <= l.top)),
depths AS (SELECT s, m, 1 + CAST(floor(log(3 * m + 1.5) / log(4)) AS INTEGER) AS level FROM reach),
found AS (SELECT s, 'https://site' || s || '.example.org/kb' AS root_url, 'https://site' || s || '.example.org/kb' AS url, 0 AS level FROM limits
 UNION ALL SELECT s, 'https://site' || s || '.example.org/kb', 'https://site' || s || '.example.org/kb/' || m, level FROM depths)"""
_register(
    "crawl_closure",
    lambda spark, d: crawl.discover(I.site_root_pages(spark, d), I.site_roots(spark, d), RU),
    f"WITH {_SITE} SELECT root_url, url, level FROM found",
)
_register(
    "crawl_fetched",
    lambda spark, d: crawl.discover(I.site_root_pages(spark, d), I.site_roots(spark, d), EN).select("root_url", "url"),
    f"""WITH {_SITE} SELECT root_url, url FROM found
    WHERE level = 0 OR url IN (SELECT 'https://site' || (doc_id % {I.SITES}) || '.example.org/kb/' || (doc_id // {I.SITES}) FROM documents)""",
)
_register(
    "crawl_page_limit",
    lambda spark, d: crawl.discover(I.site_root_pages(spark, d), I.site_roots(spark, d), RU, max_pages=30),
    f"""WITH {_SITE}, n AS (SELECT *, row_number() OVER (PARTITION BY root_url ORDER BY level, url) AS n FROM found)
    SELECT root_url, url, level FROM n WHERE n <= 30""",
)
_register(
    "crawl_frontier",
    lambda spark, d: crawl.discover(
        _pages(spark, d), _pages(spark, d).select(F.regexp_replace("url", "^([^/]*//[^/]*).*", "$1/").alias("root_url")), KG, strict_parity=True
    ),
    rf"""SELECT DISTINCT regexp_extract({q.canonical('url')}, '^[a-z]+://[^/]*') || '/' AS root_url,
    regexp_extract({q.canonical('url')}, '^[a-z]+://[^/]*') || '/' AS url, 0 AS level FROM pages""",
)


def _page_seeds(spark, d):
    """Every page's URL as a root, and the first folder of its path."""
    return _pages(spark, d).select(F.col("url").alias("root_url")).union(
        _pages(spark, d).select(F.regexp_replace("url", "^([^/]*//[^/]*/[^/]*).*", "$1").alias("root_url"))
    ).distinct()


_REACH = rf"""{_SQL_LINKS}, roots AS (SELECT {q.canonical('url')} AS r FROM pages UNION
      SELECT regexp_extract({q.canonical('url')}, '^[a-z]+://[^/]*/[^/]*') FROM pages),
    reach AS (SELECT r AS root_url, r AS url, 0 AS level FROM roots UNION
      SELECT r, link, 1 FROM roots JOIN links ON page = r WHERE link <> r AND link LIKE r || '/%')"""
_register(
    "crawl_from_pages",
    lambda spark, d: crawl.discover(_pages(spark, d), _page_seeds(spark, d), RU).select("root_url", "url", "level"),
    f"WITH {_REACH} SELECT root_url, url, level FROM reach",
)
_register(
    "crawl_accounts",
    lambda spark, d: crawl.crawl_accounts(_pages(spark, d), _page_seeds(spark, d), RU),
    rf"""WITH {_REACH}, have AS (SELECT DISTINCT {q.canonical('url')} AS url FROM pages),
    edges AS (SELECT a.root_url, count(*) AS n FROM reach a JOIN (SELECT DISTINCT page, link FROM links) l ON l.page = a.url
      JOIN reach b ON b.root_url = a.root_url AND b.url = l.link AND (b.level > a.level OR b.level = a.level AND b.url > a.url) GROUP BY 1)
    SELECT r.root_url, count(*) AS visited, count(*) FILTER (WHERE level > 0) AS discovered, coalesce(any_value(n), 0)::BIGINT AS enqueued,
     count(*) FILTER (WHERE h.url IS NULL) AS failed, count(h.url) AS saved
    FROM reach r LEFT JOIN have h ON h.url = r.url LEFT JOIN edges e ON e.root_url = r.root_url GROUP BY r.root_url""",
)
_register(
    "crawl_counts",
    lambda spark, d: crawl.crawl_counts(
        crawl.discover(I.site_root_pages(spark, d), I.site_roots(spark, d), RU),
        I.site_root_pages(spark, d).select(canonical_url(F.col("url")).alias("url")),
    ),
    f"""WITH {_SITE}, have AS (SELECT DISTINCT 'https://site' || (doc_id % {I.SITES}) || '.example.org/kb/' || (doc_id // {I.SITES}) AS url FROM documents)
    SELECT root_url, count(*) AS discovered, count(*) FILTER (WHERE level = 0 OR url IN (SELECT url FROM have)) AS saved FROM found GROUP BY root_url""",
)
_register(
    "site_corpus",
    lambda spark, d: collect_site(
        I.site_root_pages(spark, d).unionByName(I.site_pages(spark, d)), "https://site3.example.org/kb", RU, "ru"
    ).select("source_url", "category", _tidy("subcategory_path").alias("subcategory_path"), "content_text"),
    f"""WITH {_SITE} SELECT url AS source_url, 'kb' AS category, CASE WHEN level = 0 THEN '' ELSE regexp_extract(url, '[^/]*$') END AS subcategory_path,
    CASE WHEN level = 0 THEN 'start' ELSE 'next next next next next next file m x' END AS content_text FROM found
    WHERE s = 3 AND (level = 0 OR url IN (SELECT 'https://site' || (doc_id % {I.SITES}) || '.example.org/kb/' || (doc_id // {I.SITES}) FROM documents))""",
)
