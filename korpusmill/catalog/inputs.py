"""Tables the queries run on, each derived from a given table, in Spark and in SQL.

The given pages and documents lack ports, breadcrumbs, Cyrillic, page layout
and tables of contents; these derivations put such things in, row by row, so
the work grows with the data.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korpusmill.catalog import sql as q
from korpusmill.functions.text import normalize_space

NBSP, EM_SPACE, LINE_SEP = chr(0xA0), chr(0x2003), chr(0x2028)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents with unusual white space and line breaks
def spaced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("text"), F.lit(", "), F.lit(f",{NBSP}\t "))
    text = F.replace(text, F.lit(". "), F.lit(f".{LINE_SEP}{EM_SPACE}"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


SPACED = (
    "spaced AS (SELECT doc_id, replace(replace(text, ', ', ',' || chr(160) || chr(9) || ' '), "
    "'. ', '.' || chr(8232) || chr(8195)) AS text FROM documents)"
)


# --- documents in three languages: French ones become Kyrgyz or Russian, some German ones mixed
LATIN, CYRILLIC = "abeiklmnopstuv", "абеиклмнопстув"


def trilingual_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    swapped = F.translate(t, LATIN, CYRILLIC)
    text = (
        F.when((F.col("lang") == "fr") & (F.col("doc_id") % 2 == 0), F.concat(swapped, F.lit(" Өлкө")))
        .when(F.col("lang") == "fr", swapped)
        .when((F.col("lang") == "de") & (F.col("doc_id") % 3 == 0), F.translate(t, LATIN[:6], CYRILLIC[:6]))
        .when(F.col("doc_id") % 17 == 0, F.regexp_replace(t, r"\p{L}+", "7"))
        .when(F.col("doc_id") % 19 == 0, F.lit(f" {NBSP}\n"))
        .otherwise(t)
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


TRILINGUAL = rf"""trilingual AS (SELECT doc_id, CASE
 WHEN lang = 'fr' AND doc_id % 2 = 0 THEN translate(text, '{LATIN}', '{CYRILLIC}') || ' Өлкө'
 WHEN lang = 'fr' THEN translate(text, '{LATIN}', '{CYRILLIC}')
 WHEN lang = 'de' AND doc_id % 3 = 0 THEN translate(text, '{LATIN[:6]}', '{CYRILLIC[:6]}')
 WHEN doc_id % 17 = 0 THEN regexp_replace(text, '\p{{L}}+', '7', 'g')
 WHEN doc_id % 19 = 0 THEN ' ' || chr(160) || chr(10) ELSE text END AS text FROM documents)"""


# --- documents with a legal tail
def footed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.element_at(
        F.array(*map(F.lit, FOOTERS)), (F.col("doc_id") % len(FOOTERS) + 1).cast("int")
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(normalize_space(F.col("text")), F.lit(" "), tail).alias("text")
    )


FOOTERS = (
    "© 2024 Все права защищены", "ALL RIGHTS RESERVED 😀", "Публичная оферта", "Условия  использования сайта",
    "ПОЛИТИКА конфиденциальности", "Телефон: 0312", "тип связи", "no tail here", "",
)
FOOTED = (
    f"footed AS (SELECT doc_id, {q.norm_space('text')} || ' ' || "
    f"[{', '.join(map(q.quote, FOOTERS))}][doc_id % {len(FOOTERS)} + 1] AS text FROM documents)"
)


# --- pages whose URLs have ports, capitals, doubled slashes, parameters and files
def varied_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, k = F.col("url"), F.col("page_id") % 6
    url = (
        F.when(k == 1, F.regexp_replace(u, r"^http(s?)://([^/]*)", "HTTP$1://WWW.$2"))
        .when(k == 2, F.regexp_replace(u, r"^http://([^/]*)", "http://$1:80"))
        .when(k == 3, F.regexp_replace(u, r"^https://([^/]*)", "https://$1:443"))
        .when(k == 4, F.regexp_replace(u, r"/(en|de|fr|es)/", "//$1///"))
        .when(k == 5, F.regexp_replace(u, r"^([^?#]*)", "$1/file.PDF;v=1"))
        .otherwise(u)
    )
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


VARIED = r"""varied AS (SELECT page_id, CASE page_id % 6
 WHEN 1 THEN regexp_replace(url, '^http(s?)://([^/]*)', 'HTTP\1://WWW.\2')
 WHEN 2 THEN regexp_replace(url, '^http://([^/]*)', 'http://\1:80')
 WHEN 3 THEN regexp_replace(url, '^https://([^/]*)', 'https://\1:443')
 WHEN 4 THEN regexp_replace(url, '/(en|de|fr|es)/', '//\1///')
 WHEN 5 THEN regexp_replace(url, '^([^?#]*)', '\1/file.PDF;v=1')
 ELSE url END AS url FROM pages)"""


# --- pages with breadcrumbs, interactive parts and noise blocks
def rich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, k = F.col("html"), F.col("page_id") % 4
    html = (
        F.when(k == 0, F.regexp_replace(h, "<nav><ul>", '<nav aria-label="Breadcrumb"><ul>'))
        .when(k == 1, F.regexp_replace(h, "<nav><ul>", "<nav><ul class='main breadcrumbs'>"))
        .when(
            k == 2,
            F.regexp_replace(h, '<div class="ad">', '<div class="cookie-banner"><button aria-expanded="false">Ok</button>'),
        )
        .otherwise(F.regexp_replace(h, "<article>", '<article class="faq tabs">'))
    )
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


RICH = r"""rich AS (SELECT page_id, url, CASE page_id % 4
 WHEN 0 THEN replace(html, '<nav><ul>', '<nav aria-label="Breadcrumb"><ul>')
 WHEN 1 THEN replace(html, '<nav><ul>', '<nav><ul class=''main breadcrumbs''>')
 WHEN 2 THEN replace(html, '<div class="ad">', '<div class="cookie-banner"><button aria-expanded="false">Ok</button>')
 ELSE replace(html, '<article>', '<article class="faq tabs">') END AS html FROM pages)"""


# --- a web site per seven documents: page m links to pages 4m+1 to 4m+4 and back to m/4
SITES = 7


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.floor(F.col("doc_id") / SITES).cast("bigint")
    host = F.concat(F.lit("https://site"), (F.col("doc_id") % SITES).cast("string"), F.lit(".example.org"))

    def link(path, target):
        return F.concat(F.lit('<a class="n" href="'), path, target.cast("string"), F.lit('">next</a>'))

    down = [link(F.lit("/kb/"), m * 4 + i) for i in (1, 2)] + [link(F.lit("./"), m * 4 + i) for i in (3, 4)]
    links = F.concat(
        *down,
        link(F.lit("../kb/x/../"), F.floor(m / 4)),
        link(F.lit("/other/"), m),
        F.concat(F.lit('<a href="/kb/'), m.cast("string"), F.lit('.pdf">file</a><a href="mailto:a@b.c">m</a>')),
        F.concat(F.lit('<a href="//elsewhere.example.com/kb/'), m.cast("string"), F.lit('">x</a>')),
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"),
        F.concat(host, F.lit("/kb/"), m.cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), links, F.lit("</body></html>")).alias("html"),
    )


def site_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = table(spark, sf_dir, "documents").select((F.col("doc_id") % SITES).cast("string").alias("s")).distinct()
    return hosts.select(F.concat(F.lit("https://SITE"), "s", F.lit(".example.org/kb/")).alias("root_url"))


def site_root_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site pages plus each root, which links to page 0."""
    roots = site_roots(spark, sf_dir).select(
        F.lit(-1).cast("bigint").alias("page_id"),
        F.col("root_url").alias("url"),
        F.lit('<a href="0?x=1#top">start</a>').alias("html"),
    )
    return site_pages(spark, sf_dir).unionByName(roots)


# --- document lines: even documents are left sides, odd ones right sides
def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("ln", "t"))
    ln, t = F.col("ln"), F.col("t")
    text = (
        F.when(ln % 7 == 0, F.concat((F.floor(ln / 7) + 1).cast("string"), F.lit(". "), t))
        .when(ln % 11 == 5, F.concat(F.lit("Статья "), ln.cast("string"), F.lit(" "), t))
        .when(ln % 13 == 3, F.concat(t, F.lit(" — аныктама")))
        .otherwise(t)
    )
    lines = raw.where(F.trim("t") != "").select(
        F.floor(F.col("doc_id") / 2).cast("bigint").alias("doc_id"),
        F.when(F.col("doc_id") % 2 == 0, "left").otherwise("right").alias("side"),
        ln.cast("bigint").alias("line_no"),
        (F.floor(ln / 5) + 1).cast("int").alias("page"),
        text.alias("text"),
        (F.length("t") % 13 == 0).alias("is_bold"),
        F.when(F.length("t") % 11 == 0, 14.0).otherwise(10.0).alias("font_size"),
    )
    return lines.withColumn("text", normalize_space(F.col("text")))  # a step of its own, which puts texts together once


def place_in_column() -> Column:
    """Where a line stands if the sides' lines take turns in one column."""
    return F.col("line_no") * 2 + F.when(F.col("side") == "right", 1).otherwise(0)


def column_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of both sides as single-column documents."""
    return document_lines(spark, sf_dir).withColumn("line_no", place_in_column()).withColumn("side", F.lit("left"))


LINES = f"""raw_lines AS (
 SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(len(string_split(text, chr(10))))) AS ln
 FROM documents),
lines AS (
 SELECT doc_id // 2 AS doc_id, CASE WHEN doc_id % 2 = 0 THEN 'left' ELSE 'right' END AS side, ln AS line_no,
  CAST(ln // 5 + 1 AS INTEGER) AS page,
  {q.norm_space('''CASE WHEN ln % 7 = 0 THEN (ln // 7 + 1) || '. ' || t WHEN ln % 11 = 5 THEN 'Статья ' || ln || ' ' || t
  WHEN ln % 13 = 3 THEN t || ' — аныктама' ELSE t END''')} AS text,
  length(t) % 13 = 0 AS is_bold, CASE WHEN length(t) % 11 = 0 THEN 14.0 ELSE 10.0 END::DOUBLE AS font_size
 FROM raw_lines WHERE trim(t) <> '')"""


# --- text spans: every line is cut in three and laid out on a page
def document_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    cuts = F.array(
        F.struct(F.lit(1).alias("span_no"), F.substring(F.col("text"), F.lit(1), third).alias("t")),
        F.struct(F.lit(2).alias("span_no"), F.substring(F.col("text"), third + 1, third).alias("t")),
        F.struct(F.lit(3).alias("span_no"), F.substring(F.col("text"), third * 2 + 1, n).alias("t")),
    )
    line, left = F.col("line_no"), F.col("side") == "left"
    x0 = F.when(left, 40.0).otherwise(310.0) + F.when(line % 2 == 0, 0.0).otherwise(3.3)
    return lines.select("*", F.explode(cuts).alias("s")).select(
        "doc_id",
        "page",
        F.when(line % 29 == 7, 1).otherwise(0).alias("block_type"),
        F.lit(0).alias("block_no"),
        line.cast("int").alias("line_in_block"),
        F.col("s.span_no").alias("span_no"),
        F.concat(F.lit(" "), "s.t").alias("text"),
        (F.col("font_size") + F.when(F.col("s.span_no") == 2, line % 3).otherwise(0)).alias("size"),
        F.when(F.col("is_bold") & (F.col("s.span_no") == 1), 16).otherwise(0).alias("flags"),
        F.when((F.col("s.span_no") == 3) & (line % 5 == 0), "Arial-BoldMT").otherwise("ArialMT").alias("font"),
        (x0 + F.col("s.span_no")).alias("x0"),
        (x0 + F.col("s.span_no") + 1).alias("x1"),
        F.lit(0.0).alias("page_x0"),
        F.lit(600.0).alias("page_x1"),
        x0.alias("line_x0"),
        # Two lines share a height, and the page is filled bottom up.
        (F.lit(800.0) - F.floor(line / 2) * 0.9).alias("line_y0"),
    )


SPANS = LINES + """,
spans AS (
 SELECT doc_id, page, side, line_no, span_no, CASE WHEN line_no % 29 = 7 THEN 1 ELSE 0 END AS block_type,
  CASE span_no WHEN 1 THEN substr(text, 1, length(text) // 3) WHEN 2 THEN substr(text, length(text) // 3 + 1, length(text) // 3)
   ELSE substr(text, 2 * (length(text) // 3) + 1) END AS t,
  font_size + CASE WHEN span_no = 2 THEN line_no % 3 ELSE 0 END AS size,
  (is_bold AND span_no = 1) OR (span_no = 3 AND line_no % 5 = 0) AS bold,
  (CASE WHEN side = 'left' THEN 40.0 ELSE 310.0 END + CASE WHEN line_no % 2 = 0 THEN 0 ELSE 3.3 END)::DOUBLE AS x0,
  800.0::DOUBLE - (line_no // 2) * 0.9::DOUBLE AS y0
 FROM lines, (SELECT unnest([1, 2, 3]) AS span_no))"""


COLUMN_LINES = """column_lines AS (SELECT doc_id, 'left' AS side, line_no * 2 + (side = 'right')::INT AS line_no, page, text, is_bold, font_size FROM lines)"""


# --- tables of contents: an entry for every line of both sides, with its whole text; every third one wrapped
def toc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir).withColumn("entry", place_in_column())
    entry = F.col("entry")
    start = F.concat(F.lit(" .... "), F.col("page").cast("string"))
    head = F.col("text")
    parts = (
        F.when(entry % 3 == 0, F.array(F.concat(F.lit("• "), head), F.concat(F.lit("жана уландысы"), start)))
        .when(entry % 7 == 1, F.array(F.lit("СОДЕРЖАНИЕ"), F.concat(head, start), F.lit("12"), F.lit("–")))
        .when(entry % 7 == 2, F.array(F.concat(head, start), F.concat(F.translate(head, string.ascii_lowercase, string.ascii_uppercase), start), F.concat(head, F.lit(" 9000"))))
        .otherwise(F.array(F.concat(head, start), F.concat(F.lit("Тиркеме"), start)))
    )
    return lines.select(
        "doc_id",
        (F.floor(entry / 40) + 1).cast("int").alias("toc_page"),
        (entry * 10).alias("base"),
        F.posexplode(parts).alias("part", "text"),
    ).select("doc_id", "toc_page", (F.col("base") + F.col("part")).alias("line_no"), "text")


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_lines(spark, sf_dir).groupBy("doc_id").agg(F.max("page").alias("page_count"))


TOC_LINES = LINES + """,
toc_parts AS (
 SELECT doc_id, entry // 40 + 1 AS toc_page, entry * 10 AS base, CASE
  WHEN entry % 3 = 0 THEN ['• ' || text, 'жана уландысы .... ' || page]
  WHEN entry % 7 = 1 THEN ['СОДЕРЖАНИЕ', text || ' .... ' || page, '12', '–']
  WHEN entry % 7 = 2 THEN [text || ' .... ' || page, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || ' .... ' || page, text || ' 9000']
  ELSE [text || ' .... ' || page, 'Тиркеме .... ' || page] END AS parts
 FROM (SELECT *, line_no * 2 + (side = 'right')::INT AS entry FROM lines)),
toc_raw AS (SELECT doc_id, toc_page, base + i AS line_no, parts[i + 1] AS text
 FROM (SELECT *, unnest(range(len(parts))) AS i FROM toc_parts)),
page_counts AS (SELECT doc_id, max(page) AS page_count FROM lines GROUP BY doc_id)"""
