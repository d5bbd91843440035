"""Registered queries on document lines, sections, contents, pairing and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from korpusmill.catalog import inputs as I
from korpusmill.catalog import sql as q
from korpusmill.catalog.text import SQL_QUALITY, sql_section_key, sql_toc_key
from korpusmill.functions.headers import section_key
from korpusmill.operators import dedupe, layout, naming, ordering, pairing, rejects, sections, toc
from korpusmill.plans import pdf_corpus
from korpusmill.session import shared_folder
from korpusmill.sinks.files import read_section_files, write_section_files
from korpusmill.sources import pdf

QUERIES, ORACLES = {}, {}


def _register(name, query, oracle=None):
    QUERIES[name] = query
    if oracle:
        ORACLES[name] = oracle


def _pages(c="page_numbers"):
    return F.array_join(F.transform(F.col(c), lambda p: p.cast("string")), ",").alias("pages")


def _shown(df, *extra):
    return df.select("doc_id", "side", "section_no", "name", "section_key", _pages(), F.sha1("content").alias("digest"), *extra)


# --- positioned spans to lines
def _sql_lines_of(side_filter: str, order: str) -> str:
    return f"""WITH {I.SPANS},
    kept AS (SELECT * FROM spans WHERE block_type = 0 AND {side_filter}),
    grouped AS (SELECT doc_id, page, line_no AS lb, {q.norm_space("string_agg(trim(t), ' ' ORDER BY span_no) FILTER (WHERE trim(t) <> '')")} AS text,
     count(*) FILTER (WHERE bold) >= greatest(1, count(*) // 2) AS is_bold, median(size) AS font_size, min(x0) AS x0, min(y0) AS y0
     FROM kept GROUP BY doc_id, page, line_no, side)
    SELECT doc_id, page, (page::BIGINT << 20) + row_number() OVER (PARTITION BY doc_id, page ORDER BY {order}) AS line_no,
     text, is_bold, font_size FROM grouped WHERE text <> ''"""


def _side_lines(side, by_position):
    def run(spark, d):
        return layout.lines_from_spans(I.document_spans(spark, d), side, 0.02, by_position).drop("side")

    return run


_register("lines_left_side", _side_lines("left", False), _sql_lines_of("side = 'left'", "lb"))
_register(
    "lines_right_side_sorted", _side_lines("right", True),
    _sql_lines_of("side = 'right' AND x0 + span_no + 0.5 >= 312", "trunc(y0 * 10), trunc(x0 * 10), lb"),
)


def _whole_pages(spark, d):
    """Both sides, read as single-column pages."""
    spans = I.document_spans(spark, d).withColumn("line_in_block", F.col("line_in_block") * 2 + F.when(F.col("line_x0") < 300, 0).otherwise(1))
    return layout.lines_from_spans(spans, None, by_position=True).drop("side")


_register("lines_whole_page_sorted", _whole_pages, _sql_lines_of("TRUE", "trunc(y0 * 10), trunc(x0 * 10), lb"))


def _page_ranges(spark, d):
    counts = I.page_counts(spark, d)
    k = F.col("doc_id")
    asked_from = F.when(k % 3 != 0, (k % 2 - 1).cast("int"))
    asked_to = F.when(k % 4 != 0, (k % 50 + 1).cast("int"))
    r = layout.page_range(asked_from, asked_to, F.col("page_count"))
    path = layout.checked_pdf_path(F.concat(F.lit("d"), k.cast("string"), F.when(k % 2 == 0, ".PDF").otherwise(".pdf")))
    return counts.select("doc_id", path.alias("path"), r.alias("r")).select("doc_id", "path", "r.*")


_register(
    "page_ranges",
    _page_ranges,
    f"""WITH {I.LINES}, page_counts AS (SELECT doc_id, max(page) AS page_count FROM lines GROUP BY doc_id)
    SELECT doc_id, 'd' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.PDF' ELSE '.pdf' END AS path, 1 AS page_from,
    CAST(least(page_count, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 50 + 1 ELSE page_count END) AS INTEGER) AS page_to FROM page_counts""",
)



def _requests(spark, d):
    """What is asked of each document: some ranges end before they start, some paths are no PDFs, some lack their number of pages."""
    k = F.col("doc_id")
    name = F.when(k % 11 == 3, ".docx").when(k % 2 == 0, ".PDF").otherwise(".pdf")
    return I.page_counts(spark, d).select(
        "doc_id",
        F.when(k % 13 != 5, F.concat(F.lit("d"), k.cast("string"), name)).alias("path"),
        F.when(k % 3 != 0, (k % 7 - 1).cast("int")).alias("page_from"),
        F.when(k % 4 != 0, (k % 50 + 1).cast("int")).alias("page_to"),
        F.when(k % 17 != 9, F.col("page_count")).alias("page_count"),
    )


def _accepted(spark, d):
    good, bad = rejects.accept_requests(_requests(spark, d))
    columns = ["doc_id", "path", "page_from", "page_to", "reason"]
    return good.withColumn("reason", F.lit(None).cast("string")).select(columns).unionByName(bad.select(columns))


_register(
    "page_requests",
    _accepted,
    f"""WITH {I.LINES}, page_counts AS (SELECT doc_id, max(page) AS n FROM lines GROUP BY doc_id),
    asked AS (SELECT doc_id, CASE WHEN doc_id % 13 <> 5 THEN 'd' || doc_id || CASE WHEN doc_id % 11 = 3 THEN '.docx' WHEN doc_id % 2 = 0 THEN '.PDF' ELSE '.pdf' END END AS path,
     CASE WHEN doc_id % 3 <> 0 THEN doc_id % 7 - 1 END::INTEGER AS page_from, CASE WHEN doc_id % 4 <> 0 THEN doc_id % 50 + 1 END::INTEGER AS page_to,
     CASE WHEN doc_id % 17 <> 9 THEN n END AS n FROM page_counts),
    judged AS (SELECT *, greatest(1, coalesce(page_from, 1))::INTEGER AS a, least(n, coalesce(page_to, n))::INTEGER AS b,
     CASE WHEN path IS NULL THEN 'no path' WHEN NOT ends_with(lower(path), '.pdf') THEN 'not a PDF: ' || path END AS p FROM asked),
    reasons AS (SELECT *, CASE WHEN n IS NULL THEN 'unknown number of pages' WHEN n > 0 AND a > b THEN 'invalid page range ' || a || ' to ' || b || ' of ' || n END AS r FROM judged),
    said AS (SELECT *, nullif(concat_ws('; ', p, r), '') AS reason FROM reasons)
    SELECT doc_id, path, CASE WHEN reason IS NULL THEN a ELSE page_from END AS page_from, CASE WHEN reason IS NULL THEN b ELSE page_to END AS page_to, reason FROM said""",
)


def _toc_requests(spark, d):
    """Every page that holds contents, and pages before and behind the document."""
    k = F.col("doc_id")
    asked = I.page_counts(spark, d).select(k, F.explode(F.array(F.lit(0), F.lit(1), F.lit(7), F.col("page_count"), F.col("page_count") + 1)).alias("toc_page"))
    good, bad = rejects.accept_toc_pages(asked, I.page_counts(spark, d))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.select("doc_id", "toc_page", "reason"))


_register(
    "toc_page_requests",
    _toc_requests,
    f"""WITH {I.LINES}, page_counts AS (SELECT doc_id, max(page) AS n FROM lines GROUP BY doc_id),
    asked AS (SELECT doc_id, n, unnest([0, 1, 7, n, n + 1])::INTEGER AS toc_page FROM page_counts)
    SELECT doc_id, toc_page, CASE WHEN toc_page < 1 OR toc_page > n THEN 'TOC page out of range: ' || toc_page || ' of ' || n END AS reason FROM asked""",
)

# --- headers and sections
_THRESHOLDS = """thresholds AS (SELECT doc_id, side, count(*) FILTER (WHERE font_size > 0) AS n_sizes,
 CASE WHEN count(*) FILTER (WHERE font_size > 0) >= 12 THEN median(font_size) * 1.2::DOUBLE ELSE 0 END::DOUBLE AS threshold
 FROM lines GROUP BY doc_id, side)"""
_LEGAL = (
    rf"(?i)^(?:(?:статья|ст\.|раздел|пункт|п\.){q.WS}*{q.D}|глава{q.WS}*(?:[IVXLCDM]|{q.D})|приложение{q.WS}*(?:[A-ZА-Я]|{q.D}))"
)
_DEF = rf"(?i){q.WS}[–—-]{q.WS}+[a-zа-яёҥүө0-9]"
_TITLE = rf"^[A-ZА-ЯЁҢҮӨ][\p{{L}}\p{{N}}_\-,–—:()«»{chr(34)}'’{q.WS[1:-1]}]+$"
_HEADERS = f"""{I.LINES}, {_THRESHOLDS},
headed AS (SELECT l.*, CASE WHEN {q.has('text', _LEGAL)} THEN true
 WHEN {sql_section_key('text')} IS NOT NULL AND NOT {q.has('text', _DEF)} AND length(text) >= 5 THEN true
 WHEN {q.has('text', _DEF)} THEN false
 WHEN threshold > 0 AND font_size >= threshold AND length(text) <= 240 THEN true
 WHEN is_bold AND length(text) <= 160 AND {q.has('text', _TITLE)} THEN ({SQL_QUALITY.format(x='text')}) >= 0.8
 ELSE false END AS is_header FROM lines l JOIN thresholds USING (doc_id, side))"""
_SECTIONS = f"""{_HEADERS},
numbered AS (SELECT *, sum(is_header::INT) OVER (PARTITION BY doc_id, side ORDER BY line_no) AS section_no FROM headed),
sections AS (SELECT doc_id, side, section_no::BIGINT AS section_no,
 coalesce(min(text) FILTER (WHERE is_header), 'Full Document') AS name, {sql_section_key('min(text) FILTER (WHERE is_header)')} AS section_key,
 list_sort(list_distinct(list(page))) AS page_numbers, string_agg(text, chr(10) ORDER BY line_no) AS content
 FROM numbered GROUP BY doc_id, side, section_no)"""
_SQL_SHOWN = "doc_id, side, section_no, name, section_key, array_to_string(page_numbers, ',') AS pages, sha1(content) AS digest"


def _sections(spark, d):
    return sections.split_sections(I.document_lines(spark, d))


_register(
    "font_thresholds",
    lambda spark, d: sections.font_thresholds(I.document_lines(spark, d)),
    f"WITH {I.LINES}, {_THRESHOLDS} SELECT * FROM thresholds",
)
_register(
    "header_lines",
    lambda spark, d: sections.with_headers(I.document_lines(spark, d)).select("doc_id", "side", "line_no", "is_header"),
    f"WITH {_HEADERS} SELECT doc_id, side, line_no, is_header FROM headed",
)
_register("header_sections", lambda spark, d: _shown(_sections(spark, d)), f"WITH {_SECTIONS} SELECT {_SQL_SHOWN} FROM sections")
_register(
    "whole_documents",
    lambda spark, d: _shown(sections.whole_document(I.document_lines(spark, d))),
    f"""WITH {I.LINES} SELECT doc_id, side, 0::BIGINT AS section_no, 'Full Document' AS name, CAST(NULL AS VARCHAR) AS section_key,
    array_to_string(list_sort(list_distinct(list(page))), ',') AS pages, sha1(string_agg(text, chr(10) ORDER BY line_no)) AS digest
    FROM lines GROUP BY doc_id, side""",
)

# --- duplicates
_EXACT = f"""{_SECTIONS},
hashed AS (SELECT *, sha1(lower({q.norm_space('content')})) AS h FROM sections),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, side, h ORDER BY length(content) DESC, section_no) AS n,
 min(section_no) OVER (PARTITION BY doc_id, side, h) AS position FROM hashed),
uniq AS (SELECT *, lower({q.norm_space('content')}) AS norm FROM ranked WHERE n = 1)"""
_KEPT = f"""{_EXACT},
kept AS (SELECT * FROM uniq a WHERE NOT EXISTS (SELECT 1 FROM uniq b WHERE b.doc_id = a.doc_id AND b.side = a.side
 AND b.section_no <> a.section_no AND a.norm <> '' AND contains(b.norm, a.norm) AND len(list_filter(a.page_numbers, lambda p: NOT list_contains(b.page_numbers, p))) = 0
 AND (length(b.content) > length(a.content) OR (length(b.content) = length(a.content) AND b.position < a.position))))"""
_register(
    "exact_dedupe",
    lambda spark, d: _shown(dedupe.dedupe_exact(_sections(spark, d)), "position"),
    f"WITH {_EXACT} SELECT {_SQL_SHOWN}, position FROM uniq",
)
_register(
    "section_dedupe",
    lambda spark, d: _shown(dedupe.dedupe_sections(_sections(spark, d))),
    f"WITH {_KEPT} SELECT {_SQL_SHOWN} FROM kept",
)


def _fragments(spark, d):
    """Sections plus pieces of them: inside their pages, beyond them, and short ones."""
    whole = _sections(spark, d)
    text, n = F.col("content"), F.length("content")
    pieces = F.array(
        F.struct(F.lit(1).alias("k"), text.alias("content"), F.col("page_numbers").alias("p")),
        F.struct(F.lit(2).alias("k"), F.substring(text, F.lit(4), F.floor(n / 2).cast("int")).alias("content"), F.col("page_numbers").alias("p")),
        F.struct(F.lit(3).alias("k"), F.substring(text, F.lit(3), F.floor(n / 2).cast("int")).alias("content"),
                 F.array_append(F.col("page_numbers"), F.lit(0)).alias("p")),
        F.struct(F.lit(4).alias("k"), F.substring(text, F.lit(6), F.lit(7)).alias("content"), F.slice("page_numbers", 1, 1).alias("p")),
    )
    return whole.select("*", F.explode(pieces).alias("f")).select(
        "doc_id", "side", (F.col("section_no") * 4 + F.col("f.k")).alias("section_no"), "name", "section_key",
        F.array_sort("f.p").alias("page_numbers"), F.col("f.content").alias("content"),
    )


_FRAGMENTS = f"""{_SECTIONS},
frag AS (SELECT doc_id, side, section_no * 4 + k AS section_no, name, section_key,
 list_sort(CASE k WHEN 3 THEN list_append(page_numbers, 0) WHEN 4 THEN page_numbers[1:1] ELSE page_numbers END) AS page_numbers,
 CASE k WHEN 1 THEN content WHEN 2 THEN substr(content, 4, length(content) // 2) WHEN 3 THEN substr(content, 3, length(content) // 2) ELSE substr(content, 6, 7) END AS content
 FROM sections, (SELECT unnest([1, 2, 3, 4]) AS k))"""
_register(
    "contained_dedupe",
    lambda spark, d: _shown(dedupe.dedupe_sections(_fragments(spark, d))),
    "WITH " + _KEPT.replace(_SECTIONS, _FRAGMENTS, 1).replace("AS h FROM sections)", "AS h FROM frag)", 1) + f" SELECT {_SQL_SHOWN} FROM kept",
)
_ORDER = "page_numbers[1], coalesce(section_key, ''), name, length(content) DESC, position"
_register(
    "section_order",
    lambda spark, d: pairing.number_sections(dedupe.dedupe_exact(_sections(spark, d))).select("doc_id", "side", "section_no", "place"),
    f"WITH {_EXACT} SELECT doc_id, side, section_no, row_number() OVER (PARTITION BY doc_id, side ORDER BY {_ORDER}) AS place FROM uniq",
)

# --- pairing
def _pairs(df):
    return df.select("doc_id", "pair_id", F.col("left.section_no").alias("left_section"), F.col("right.section_no").alias("right_section"))


def _unkeyed(df):
    """Two documents of three lose their keys, so they pair by position."""
    return df.withColumn("section_key", F.when(F.col("doc_id") % 3 == 0, F.col("section_key")))


_PLACED = f"""{_EXACT},
placed AS (SELECT doc_id, side, section_no, name, CASE WHEN doc_id % 3 = 0 THEN section_key END AS section_key, page_numbers, content, position FROM uniq),
ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, side ORDER BY {_ORDER}) AS place,
 max(section_key IS NOT NULL) OVER (PARTITION BY doc_id) AS keyed FROM placed),
pairs AS (SELECT doc_id, section_key AS pair_id, arg_max(section_no, place) FILTER (WHERE side = 'left') AS left_section,
  arg_max(section_no, place) FILTER (WHERE side = 'right') AS right_section FROM ordered WHERE section_key IS NOT NULL GROUP BY doc_id, section_key
 UNION ALL SELECT doc_id, place::VARCHAR, max(section_no) FILTER (WHERE side = 'left'), max(section_no) FILTER (WHERE side = 'right')
 FROM ordered WHERE NOT keyed GROUP BY doc_id, place)"""
_register(
    "section_pairs",
    lambda spark, d: _pairs(pairing.pair_sections(_unkeyed(dedupe.dedupe_exact(_sections(spark, d))))),
    f"WITH {_PLACED} SELECT doc_id, pair_id, left_section, right_section FROM pairs",
)
_register(
    "pairing_losses",
    lambda spark, d: pairing.dropped_by_pairing(dedupe.dedupe_exact(_sections(spark, d))),
    f"""WITH {_EXACT} SELECT doc_id, count(*) FILTER (WHERE section_key IS NULL) AS dropped FROM uniq
    GROUP BY doc_id HAVING count(section_key) > 0""",
)


def _key_ranks(spark, d):
    """Numeric order of all dotted keys of the orders, as one group."""
    keys = I.table(spark, d, "lineitem").select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("k")).distinct()
    return ordering.row_number_in_ranges(keys.withColumn("g", F.lit("all")), ["g"], [pairing.key_order(F.col("k"))], "rank").select("k", "rank")


_register(
    "numeric_key_order",
    _key_ranks,
    """WITH k AS (SELECT DISTINCT l_orderkey || '.' || l_linenumber AS k FROM lineitem)
    SELECT k, row_number() OVER (ORDER BY split_part(k, '.', 1)::BIGINT, split_part(k, '.', 2)::BIGINT) AS rank FROM k""",
)

# --- tables of contents
_ENTRIES = f"""{I.TOC_LINES},
toc_text AS (SELECT doc_id, toc_page, line_no, {q.norm_space('text')} AS text FROM toc_raw),
toc_kept AS (SELECT * FROM toc_text WHERE length(text) > 1 AND NOT regexp_matches(text, '(?i)^(содержание|оглавление|мазмуну)([^\\p{{L}}\\p{{N}}_]|$)')
 AND NOT regexp_matches(text, '^\\p{{Nd}}{{1,4}}$')),
toc_isles AS (SELECT *, regexp_matches(text, '[^ ] \\p{{Nd}}{{1,4}}$') AS ends, coalesce(sum(regexp_matches(text, '[^ ] \\p{{Nd}}{{1,4}}$')::INT)
 OVER (PARTITION BY doc_id, toc_page ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS isle FROM toc_kept),
toc_joined AS (SELECT doc_id, toc_page, isle, min(line_no) AS line_no, string_agg(text, ' ' ORDER BY line_no) AS j FROM toc_isles
 GROUP BY doc_id, toc_page, isle HAVING bool_or(ends)),
toc_named AS (SELECT doc_id, toc_page, line_no, trim(regexp_replace(regexp_extract(j, '^(.+) (\\p{{Nd}}{{1,4}})$', 1), '^[•–— -]+', '')) AS title,
 regexp_extract(j, '^(.+) (\\p{{Nd}}{{1,4}})$', 2)::INT AS start_page FROM toc_joined),
toc_valid AS (SELECT n.* FROM toc_named n JOIN page_counts USING (doc_id) WHERE title <> '' AND start_page BETWEEN 1 AND page_count),
entries AS (SELECT doc_id, arg_min(title, toc_page * 1000000000 + line_no) AS title, start_page FROM toc_valid GROUP BY doc_id, lower(title), start_page)"""
_INTERVALS = f"""{_ENTRIES},
starts AS (SELECT doc_id, start_page, max(title) AS title FROM entries GROUP BY doc_id, start_page),
intervals AS (SELECT doc_id, title, start_page, coalesce(lead(start_page) OVER (PARTITION BY doc_id ORDER BY start_page) - 1, page_count) AS end_page
 FROM starts JOIN page_counts USING (doc_id))"""
_TOC_SECTIONS = f"""{_INTERVALS},
sides AS (SELECT DISTINCT doc_id, side FROM lines),
sections AS (SELECT i.doc_id, s.side, start_page::BIGINT AS section_no, title AS name, {sql_toc_key('title')} AS section_key,
 list_sort(list_distinct(coalesce(list(page) FILTER (WHERE page IS NOT NULL), []))) AS page_numbers, coalesce(string_agg(text, chr(10) ORDER BY line_no), '') AS content
 FROM intervals i JOIN sides s USING (doc_id) LEFT JOIN lines l ON l.doc_id = i.doc_id AND l.side = s.side AND l.page BETWEEN start_page AND end_page
 GROUP BY i.doc_id, s.side, start_page, title),
ranked AS (SELECT *, sha1(lower({q.norm_space('content')})) AS h FROM sections),
toc_uniq AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY doc_id, side, h ORDER BY length(content) DESC, section_no) = 1)"""


_COLUMN_SECTIONS = f"{_TOC_SECTIONS}".replace("sides AS (SELECT DISTINCT doc_id, side FROM lines)", f"{I.COLUMN_LINES},\nsides AS (SELECT DISTINCT doc_id, side FROM column_lines)")
_COLUMN_SECTIONS = _COLUMN_SECTIONS.replace("LEFT JOIN lines l", "LEFT JOIN column_lines l")


def _sides_of(sql: str, lines: str) -> str:
    """The check query over the lines of one side."""
    return sql.replace("SELECT DISTINCT doc_id, side FROM lines", f"SELECT DISTINCT doc_id, side FROM lines WHERE {lines}")


def _counts(spark, d):
    """All pages are read."""
    return I.page_counts(spark, d).withColumn("page_from", F.lit(1)).withColumn("page_to", F.col("page_count"))


def _toc_sections(spark, d):
    return pdf_corpus.toc_sections(I.document_lines(spark, d), I.toc_lines(spark, d), _counts(spark, d))


def _checked_toc(spark, d):
    lines = I.toc_lines(spark, d)
    pages = toc.check_toc_pages(lines.select("doc_id", "toc_page").distinct(), I.page_counts(spark, d))
    return lines.join(pages, ["doc_id", "toc_page"])


_register(
    "toc_entries",
    lambda spark, d: toc.toc_entries(_checked_toc(spark, d), I.page_counts(spark, d)).select("doc_id", "title", "start_page"),
    f"WITH {_ENTRIES} SELECT doc_id, title, start_page FROM entries",
)
_register(
    "toc_preview",
    lambda spark, d: toc.toc_preview(toc.toc_entries(I.toc_lines(spark, d), I.page_counts(spark, d))),
    f"""WITH {_ENTRIES}, p AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_page, title) AS INTEGER) AS nth,
    title, start_page FROM entries) SELECT * FROM p WHERE nth <= 15""",
)
_register(
    "toc_intervals",
    lambda spark, d: toc.toc_intervals(toc.toc_entries(I.toc_lines(spark, d), I.page_counts(spark, d)), _counts(spark, d)),
    f"WITH {_INTERVALS} SELECT doc_id, title, start_page, end_page FROM intervals",
)
_register("toc_sections", lambda spark, d: _shown(_toc_sections(spark, d)), f"WITH {_TOC_SECTIONS} SELECT {_SQL_SHOWN} FROM toc_uniq")
_register(
    "majority_language",
    lambda spark, d: naming.majority_language(
        I.trilingual_documents(spark, d).select(F.floor(F.col("doc_id") / 6).alias("doc_id"), F.col("text").alias("content"))
    ),
    f"""WITH {I.TRILINGUAL}, l AS (SELECT doc_id // 6 AS doc_id, {q.language('text')} AS language FROM trilingual),
    c AS (SELECT doc_id, language, count(*) AS n FROM l GROUP BY doc_id, language)
    SELECT doc_id, language, {q.folder('language')} AS folder FROM c
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, language) = 1""",
)

# --- records and files
def _sources(spark, d):
    docs = I.table(spark, d, "documents").select(F.floor(F.col("doc_id") / 2).cast("bigint").alias("doc_id")).distinct()
    stem = F.concat(F.lit("Мыйзам: "), F.col("doc_id").cast("string"))
    return docs.select("doc_id", F.concat(stem, F.lit(".pdf")).alias("source_name"), stem.alias("stem"))


_SQL_SOURCE = "'Мыйзам: ' || doc_id || '.pdf'"
_SQL_STEM = "'Мыйзам_ ' || doc_id"


def _sql_record(lang: str) -> str:
    return f"""json_object('source_name', {_SQL_SOURCE}, 'content', content, 'metadata', json_object('section_name', name,
    'page_numbers', page_numbers, 'language', {lang}, 'rag_header', '[Document: ' || {_SQL_SOURCE} || ']' || chr(10) || '[Section: ' || name || ']'))"""


def _record_fields(files):
    m = "record.metadata"
    return files.select(
        "doc_id", "folder", "file_name", F.sha1("record.content").alias("digest"),
        F.col(f"{m}.section_name").alias("section_name"), _pages(f"{m}.page_numbers"),
        F.col(f"{m}.language").alias("language"), F.col(f"{m}.rag_header").alias("rag_header"),
    )


def _sql_fields(lang: str, folder: str, name: str) -> str:
    return f"""doc_id, {folder} AS folder, {name} AS file_name, sha1(content) AS digest, name AS section_name,
    array_to_string(page_numbers, ',') AS pages, {lang} AS language,
    '[Document: ' || {_SQL_SOURCE} || ']' || chr(10) || '[Section: ' || name || ']' AS rag_header"""


def _section_json(spark, d):
    rows = dedupe.dedupe_exact(_sections(spark, d)).join(_sources(spark, d), "doc_id")
    record = naming.section_record(F.col("source_name"), F.when(F.col("side") == "left", "ky").otherwise(""))
    return rows.select("doc_id", "side", "section_no", naming.record_json(record).alias("record"))


_register(
    "section_json",
    _section_json,
    f"""WITH {_EXACT} SELECT doc_id, side, section_no,
    {_sql_record("CASE WHEN side = 'left' THEN 'ky' ELSE " + q.language('content') + " END")}::VARCHAR AS record FROM uniq""",
)
_SIDE_LANG = "CASE WHEN side = 'left' THEN 'ky' ELSE 'ru' END"
_SIDE_FOLDER = "CASE WHEN side = 'left' THEN 'kyrgyz' ELSE 'russian' END"
_PART = f"coalesce(section_key, left({q.sanitize('name')}, 24))"
_PAIR_FILE = f"{_SQL_STEM} || '__' || section_key || '__' || {_SIDE_LANG} || '__' || {q.sanitize('name')} || '.json'"
_register(
    "bilingual_files",
    lambda spark, d: _record_fields(pdf_corpus.bilingual_files(I.document_lines(spark, d), _sources(spark, d))),
    f"""WITH {_KEPT}, ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, side ORDER BY {_ORDER}) AS place,
     max(section_key IS NOT NULL) OVER (PARTITION BY doc_id) AS keyed FROM kept),
    paired AS (SELECT doc_id, side, section_no, name, CASE WHEN keyed THEN section_key ELSE place::VARCHAR END AS section_key, page_numbers, content
     FROM ordered WHERE section_key IS NOT NULL OR NOT keyed
     QUALIFY row_number() OVER (PARTITION BY doc_id, side, CASE WHEN keyed THEN section_key ELSE place::VARCHAR END ORDER BY place DESC) = 1)
    SELECT {_sql_fields(_SIDE_LANG, _SIDE_FOLDER, _PAIR_FILE)} FROM paired""",
)
_register(
    "one_side_files",
    lambda spark, d: _record_fields(pdf_corpus.bilingual_files(I.document_lines(spark, d), _sources(spark, d), take="right")),
    f"""WITH {_KEPT}, f AS (SELECT *, {_SQL_STEM} || '__' || {_PART} || '__ru__' || {q.sanitize('name')} || '.json' AS file FROM kept WHERE side = 'right')
    SELECT {_sql_fields("'ru'", "'russian'", 'file')} FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, file ORDER BY section_no DESC) = 1""",
)
_register(
    "unsplit_files",
    lambda spark, d: _record_fields(pdf_corpus.bilingual_files(I.document_lines(spark, d), _sources(spark, d), split=False)),
    f"""WITH {I.LINES}, docs AS (SELECT DISTINCT doc_id // 2 AS doc_id FROM documents),
    s AS (SELECT d.doc_id, x.side, 'Full Document' AS name, list_sort(list_distinct(coalesce(list(page) FILTER (WHERE page IS NOT NULL), []))) AS page_numbers,
     coalesce(string_agg(text, chr(10) ORDER BY line_no), '') AS content FROM docs d CROSS JOIN (SELECT unnest(['left', 'right']) AS side) x
     LEFT JOIN lines l ON l.doc_id = d.doc_id AND l.side = x.side GROUP BY d.doc_id, x.side)
    SELECT {_sql_fields(_SIDE_LANG, _SIDE_FOLDER, f"{_SQL_STEM} || '__' || {_SIDE_LANG} || '.json'")} FROM s""",
)


_register(
    "full_files",
    lambda spark, d: _record_fields(pdf_corpus.full_files(I.column_lines(spark, d), _sources(spark, d))),
    f"""WITH {I.LINES}, {I.COLUMN_LINES}, s AS (SELECT doc_id, 'Full Document' AS name, list_sort(list_distinct(list(page))) AS page_numbers,
     string_agg(text, chr(10) ORDER BY line_no) AS content FROM column_lines GROUP BY doc_id),
    t AS (SELECT *, {q.language('content')} AS lang FROM s)
    SELECT {_sql_fields('lang', q.folder('lang'), f"{_SQL_STEM} || '.json'")} FROM t""",
)
_register(
    "toc_files",
    lambda spark, d: _record_fields(pdf_corpus.toc_files(I.column_lines(spark, d), I.toc_lines(spark, d), _counts(spark, d), _sources(spark, d))),
    f"""WITH {_COLUMN_SECTIONS},
    l AS (SELECT *, {q.language('content')} AS lang FROM toc_uniq),
    v AS (SELECT doc_id, lang AS major FROM (SELECT doc_id, lang, count(*) AS n FROM l GROUP BY doc_id, lang)
     QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) = 1),
    b AS (SELECT *, {q.sanitize("'Мыйзам: ' || doc_id || '__' || " + _PART + " || '__' || name")} AS base FROM l JOIN v USING (doc_id)),
    c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(base) ORDER BY section_no) AS k FROM b)
    SELECT {_sql_fields('lang', q.folder('major'), "CASE WHEN k = 1 THEN base ELSE left(base, 160 - length('__' || k)) || '__' || k END || '.json'")} FROM c""",
)
_register(
    "toc_files_bilingual",
    lambda spark, d: _record_fields(
        pdf_corpus.toc_files(
            I.document_lines(spark, d), I.toc_lines(spark, d), _counts(spark, d), _sources(spark, d), bilingual=True
        )
    ),
    f"""WITH {_TOC_SECTIONS},
    f AS (SELECT *, {_SQL_STEM} || '__' || {_PART} || '__' || {_SIDE_LANG} || '__' || {q.sanitize('name')} || '.json' AS file FROM toc_uniq)
    SELECT {_sql_fields(_SIDE_LANG, _SIDE_FOLDER, 'file')} FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, side, file ORDER BY section_no DESC) = 1""",
)


_register(
    "toc_files_right",
    lambda spark, d: _record_fields(
        pdf_corpus.toc_files(
            I.document_lines(spark, d), I.toc_lines(spark, d), _counts(spark, d), _sources(spark, d), bilingual=True, take="right"
        )
    ),
    f"""WITH {_sides_of(_TOC_SECTIONS, "side = 'right'")},
    f AS (SELECT *, {_SQL_STEM} || '__' || {_PART} || '__ru__' || {q.sanitize('name')} || '.json' AS file FROM toc_uniq)
    SELECT {_sql_fields("'ru'", "'russian'", 'file')} FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, file ORDER BY section_no DESC) = 1""",
)


def _short_counts(spark, d):
    """Page counts three pages short, so that contents of short documents name no page they have."""
    return I.page_counts(spark, d).withColumn("page_count", F.col("page_count") - 3)


_register(
    "toc_without_entries",
    lambda spark, d: pdf_corpus.without_entries(I.toc_lines(spark, d), _short_counts(spark, d), _sources(spark, d)),
    f"""WITH {_ENTRIES.replace("max(page) AS page_count", "max(page) - 3 AS page_count")},
    docs AS (SELECT DISTINCT doc_id // 2 AS doc_id FROM documents)
    SELECT doc_id, {_SQL_SOURCE} AS source_name, 'Мыйзам: ' || doc_id AS stem FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM entries)""",
)


def _contents_lines(spark, d):
    """Raw lines of the pages whose numbers are those of contents pages, from the spans of both sides."""
    spans = I.document_spans(spark, d).withColumn("line_in_block", F.col("line_in_block") * 2 + F.when(F.col("line_x0") < 300, 0).otherwise(1))
    return pdf.toc_page_lines(spans, I.toc_lines(spark, d).select("doc_id", "toc_page").distinct())


_register(
    "contents_lines",
    _contents_lines,
    f"""WITH {I.SPANS}, toc AS (SELECT DISTINCT doc_id, CAST((line_no * 2 + (side = 'right')::INT) // 40 + 1 AS INTEGER) AS toc_page FROM lines)
    SELECT s.doc_id, toc_page, line_no * 2 + (side = 'right')::INT AS line_no, string_agg(' ' || t, '' ORDER BY span_no) AS text FROM spans s JOIN toc ON toc.doc_id = s.doc_id AND toc.toc_page = s.page
    WHERE block_type = 0 GROUP BY s.doc_id, toc_page, line_no, side""",
)


def _read_back(spark, d):
    """Files of whole documents, written one by one and read again."""
    path = shared_folder(spark, "section-files")
    write_section_files(pdf_corpus.full_files(I.column_lines(spark, d), _sources(spark, d)), path.removeprefix("file://"))
    return read_section_files(spark, path).select(
        "folder", "file_name", F.sha1("record.content").alias("digest"), F.col("record.metadata.section_name").alias("section_name"),
        _pages("record.metadata.page_numbers"), F.col("record.metadata.rag_header").alias("rag_header"),
    )


_register(
    "files_read_back",
    _read_back,
    f"""WITH {I.LINES}, {I.COLUMN_LINES}, s AS (SELECT doc_id, 'Full Document' AS name, list_sort(list_distinct(list(page))) AS page_numbers,
     string_agg(text, chr(10) ORDER BY line_no) AS content FROM column_lines GROUP BY doc_id),
    t AS (SELECT *, {q.language('content')} AS lang FROM s),
    f AS (SELECT {_sql_fields('lang', q.folder('lang'), f"{_SQL_STEM} || '.json'")} FROM t)
    SELECT folder, file_name, digest, section_name, pages, rag_header FROM f""",
)


def _collisions(spark, d):
    """Names of all orders of a day, in mixed case and of full length."""
    name = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.repeat(F.lit("-длинное имя"), 20))
    rows = I.table(spark, d, "orders").select(
        (F.col("o_custkey") % 20).alias("doc_id"), F.col("o_orderkey").alias("position"),
        F.when(F.col("o_orderkey") % 2 == 0, F.upper(name)).otherwise(name).alias("name"),
    )
    base = F.when(F.col("position") % 3 == 0, F.substring("name", 1, 7)).otherwise(F.substring("name", 1, 160))
    return naming.unique_names(rows, base, "position").select("doc_id", "position", "file_name")


_register(
    "collision_names",
    _collisions,
    """WITH n AS (SELECT o_custkey % 20 AS doc_id, o_orderkey AS position, strftime(o_orderdate, '%Y-%m-%d') || repeat('-длинное имя', 20) AS name FROM orders),
    c AS (SELECT doc_id, position, CASE WHEN position % 2 = 0 THEN upper(name) ELSE name END AS name FROM n),
    b AS (SELECT doc_id, position, CASE WHEN position % 3 = 0 THEN left(name, 7) ELSE left(name, 160) END AS base FROM c),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(base) ORDER BY position) AS k FROM b)
    SELECT doc_id, position, CASE WHEN k = 1 THEN base ELSE left(base, 160 - length('__' || k)) || '__' || k END AS file_name FROM k""",
)


def _mixed_collisions(spark, d):
    """Orders named by year, in mixed case; a quarter already carries the suffix the others need. One document holds a third."""
    key, base = F.col("o_orderkey"), F.concat(F.lit("Orders of "), F.year("o_orderdate"))
    base = F.concat(base, F.when(F.col("o_custkey") % 4 == 0, "__2").otherwise(""))
    rows = I.table(spark, d, "orders").select(
        F.when(key % 3 == 0, 0).otherwise(F.col("o_custkey") % 20).alias("doc_id"), key.alias("position"),
        F.when(key % 2 == 0, F.upper(base)).otherwise(base).alias("base"),
    )
    return naming.unique_names(rows, F.col("base"), "position").select("doc_id", "position", "file_name")


_register(
    "collision_names_mixed",
    _mixed_collisions,
    """WITH n AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 20 END AS doc_id, o_orderkey AS position, year(o_orderdate) AS y,
     o_custkey % 4 = 0 AS suffixed, 'Orders of ' || year(o_orderdate) || CASE WHEN o_custkey % 4 = 0 THEN '__2' ELSE '' END AS name FROM orders),
    r AS (SELECT *, CASE WHEN position % 2 = 0 THEN upper(name) ELSE name END AS base, row_number() OVER (PARTITION BY doc_id, y, suffixed ORDER BY position) AS k FROM n),
    f AS (SELECT doc_id, y, min(position) FILTER (suffixed) < coalesce(min(position) FILTER (NOT suffixed AND k = 2), 9e18) AS kept FROM r GROUP BY doc_id, y),
    s AS (SELECT doc_id, position, base, CASE WHEN suffixed AND NOT kept OR NOT suffixed AND kept AND k > 1 THEN k + 1 ELSE k END AS k FROM r JOIN f USING (doc_id, y))
    SELECT doc_id, position, CASE WHEN k = 1 THEN base ELSE base || '__' || k END AS file_name FROM s""",
)


def _keyed_headers(spark, d):
    """How many lines carry each key, over all documents."""
    keyed = I.document_lines(spark, d).withColumn("k", section_key(F.col("text"))).where("k is not null")
    return keyed.groupBy("side", "k").agg(F.count("*").alias("n_lines"))


_register(
    "section_key_counts",
    _keyed_headers,
    f"WITH {I.LINES}, k AS (SELECT side, {sql_section_key('text')} AS k FROM lines) SELECT side, k, count(*) AS n_lines FROM k WHERE k IS NOT NULL GROUP BY side, k",
)
