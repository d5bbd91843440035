"""Sections cut at the page numbers of a table of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korpusmill.functions.headers import toc_section_key
from korpusmill.functions.text import DIGIT, WS, ascii_digits, normalize_space, strip_space
from korpusmill.operators.ordering import BLOCK, concat_lines, with_block
from korpusmill.session import shared_folder, store

# Headings of a table of contents, and the longest page number.
TOC_HEADING = r"(?iu)^(?:содержание|оглавление|мазмуну)(?![\p{L}\p{N}_])"
MAX_TOC_PAGE = 9999
_LEADING_MARKS = rf"^[•\-–—{WS}]+"


def is_toc_text(line: Column) -> Column:
    """Not a heading, a bare page number or a single character."""
    return ~line.rlike(TOC_HEADING) & ~line.rlike(rf"^{DIGIT}{{1,4}}\z") & (F.length(line) > 1)


def clean_toc_title(c: Column) -> Column:
    return strip_space(F.regexp_replace(normalize_space(c), _LEADING_MARKS, ""))


def _ends_entry(line: Column) -> Column:
    """Whether a line with single blanks ends in one and a page number; its last word tells."""
    last = F.substring_index(line, " ", -1)
    return (F.length(last) <= 4) & last.rlike(rf"^{DIGIT}++\z") & line.contains(" ")


def check_toc_pages(toc_pages: DataFrame, page_counts: DataFrame) -> DataFrame:
    """(doc_id, toc_page); a page the document does not have is an error."""
    joined = toc_pages.join(page_counts, "doc_id")
    bad = (F.col("toc_page") < 1) | (F.col("toc_page") > F.col("page_count"))
    message = F.concat_ws(" ", F.lit("TOC page out of range:"), F.col("toc_page"), F.lit("of"), F.col("page_count"))
    page = F.when(bad, F.raise_error(message).cast("int")).otherwise(F.col("toc_page"))
    return joined.select("doc_id", page.alias("toc_page"))


def toc_entries(toc_lines: DataFrame, page_counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, title, start_page, entry_no) from raw lines (doc_id, toc_page, line_no, text).

    A title may wrap: lines collect until one ends in a page number. What is
    left at the end of a page is dropped. Repeated entries keep their first
    spelling and place.
    """
    page, place = ["doc_id", "toc_page"], ["_line", "_joined"]
    pieces = store(_entry_pieces(toc_lines, block), shared_folder(toc_lines.sparkSession, "toc-pieces"))
    whole = (F.col("_isle") > 0) & F.col("_ended")
    joined = pieces.where(whole).select(*page, *place).unionByName(_across_blocks(pieces.where(~whole)).select(*page, *place))
    # A joined entry has single blanks only, and ends in one and a number.
    number = F.substring_index("_joined", " ", -1)
    title = F.substring(F.col("_joined"), F.lit(1), F.length("_joined") - F.length(number) - 1)
    named = joined.select(*page, "_line", F.regexp_replace(title, _LEADING_MARKS, "").alias("title"), ascii_digits(number).cast("int").alias("start_page"))
    valid = named.join(page_counts, "doc_id").where(F.col("start_page").between(1, F.col("page_count")))
    first = valid.groupBy("doc_id", F.unhex(F.sha1(F.lower("title"))).alias("_title"), "start_page").agg(
        F.min(F.struct("toc_page", "_line", "title")).alias("_first")
    )
    return first.select("doc_id", F.col("_first.title").alias("title"), "start_page", F.struct("_first.toc_page", "_first._line").alias("place")).where("title != ''")


def _entry_pieces(toc_lines: DataFrame, block: int) -> DataFrame:
    """Per block of a page, its lines joined up to each that ends in a page number.

    Pieces are counted in a block from 0 (``_isle``); the last may lack its
    number (``_ended``). Rows are dealt once, by page and block. Lines that are
    no contents are left out there and not by a filter, which Spark would move
    below the normalization and so repeat it.
    """
    group = ["doc_id", "toc_page", "_block"]
    lines = with_block(toc_lines.withColumn("text", normalize_space(F.col("text"))), "line_no", block)
    lines = lines.withColumn("_kept", (F.col("text") != "") & is_toc_text(F.col("text")))
    lines = lines.select(*group, "line_no", F.when(F.col("_kept"), F.col("text")).alias("_text"), (F.col("_kept") & _ends_entry(F.col("text"))).alias("_ends"))
    before = Window.partitionBy(*group).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("_isle", F.coalesce(F.sum(F.col("_ends").cast("int")).over(before), F.lit(0)))
    line = F.when(F.col("_text").isNotNull(), F.struct(F.col("line_no").alias("o"), F.col("_text").alias("t")))
    parts = F.sort_array(F.collect_list(line))
    joined = lines.groupBy(*group, "_isle").agg(
        F.array_join(parts["t"], " ").alias("_joined"), F.min(line["o"]).alias("_line"), F.bool_or("_ends").alias("_ended")
    )
    return joined.where("_line is not null")


def _across_blocks(pieces: DataFrame) -> DataFrame:
    """Entries of the first and last pieces of blocks, two a block at most: those without number go on in the next block."""
    page = ["doc_id", "toc_page"]
    before = Window.partitionBy(*page).orderBy("_block", "_isle").rowsBetween(Window.unboundedPreceding, -1)
    counted = pieces.withColumn("_entry", F.coalesce(F.sum(F.col("_ended").cast("int")).over(before), F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_isle", "_joined")))
    joined = counted.groupBy(*page, "_entry").agg(
        F.array_join(parts["_joined"], " ").alias("_joined"), F.min("_line").alias("_line"), F.bool_or("_ended").alias("_ended")
    )
    return joined.where("_ended")


def toc_preview(entries: DataFrame, n: int = 15) -> DataFrame:
    """The first entries of each document, as a log shows them."""
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("start_page", "title"))
    return entries.select("doc_id", nth.alias("nth"), "title", "start_page").where(F.col("nth") <= n)


def toc_intervals(entries: DataFrame, page_counts: DataFrame) -> DataFrame:
    """(doc_id, title, start_page, end_page): each entry runs to the page before the next.

    ``page_counts`` may limit the range with page_from and page_to. Of several
    entries on one page only the last has any pages. Starts have four digits at
    most, so the window's groups are small.
    """
    span = page_counts.select(
        "doc_id",
        (F.col("page_from") if "page_from" in page_counts.columns else F.lit(1)).alias("_from"),
        (F.col("page_to") if "page_to" in page_counts.columns else F.col("page_count")).alias("_to"),
    )
    inside = entries.join(span, "doc_id").where(F.col("start_page").between(F.col("_from"), F.col("_to")))
    last = inside.groupBy("doc_id", "start_page", "_to").agg(F.max("title").alias("title"))
    following = F.lead("start_page").over(Window.partitionBy("doc_id").orderBy("start_page"))
    return last.select(
        "doc_id", "title", "start_page", F.coalesce(following - 1, F.col("_to")).alias("end_page")
    )


def assign_pages(pages: DataFrame, intervals: DataFrame) -> DataFrame:
    """(doc_id, page, start_page): the interval each page falls into.

    Instead of a range join, pages and starts are merged in one ordered pass
    per document. Pages beyond the highest possible start share its interval
    and are merged as one, which bounds the pass.
    """
    capped = pages.withColumn("_page", F.least(F.col("page"), F.lit(MAX_TOC_PAGE + 1)))
    marks = capped.select("doc_id", "_page").distinct().withColumn("start_page", F.lit(None).cast("int"))
    starts = intervals.select("doc_id", F.col("start_page").alias("_page"), "start_page")
    reached = Window.partitionBy("doc_id").orderBy("_page").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    merged = marks.unionByName(starts).withColumn("_start", F.max("start_page").over(reached))
    found = merged.where(F.col("start_page").isNull() & F.col("_start").isNotNull()).select("doc_id", "_page", "_start")
    return capped.join(found, ["doc_id", "_page"]).select("doc_id", "page", F.col("_start").alias("start_page"))


def sections_from_toc(lines: DataFrame, intervals: DataFrame, block: int = BLOCK) -> DataFrame:
    """One section per interval and side; an interval without lines gives an empty one.

    ``lines`` hold only the pages the intervals were cut for.
    """
    seen = store(lines.select("doc_id", "side", "page").distinct(), shared_folder(lines.sparkSession, "seen-pages"))
    pages = seen.select("doc_id", "page").distinct()
    placed = lines.join(assign_pages(pages, intervals), ["doc_id", "page"])
    bodies = concat_lines(placed, ["doc_id", "side", "start_page"], block=block)
    sides = seen.select("doc_id", "side").distinct()
    return (
        intervals.join(sides, "doc_id")
        .join(bodies, ["doc_id", "side", "start_page"], "left")
        .select(
            "doc_id",
            "side",
            F.col("start_page").cast("bigint").alias("section_no"),
            F.col("title").alias("name"),
            toc_section_key(F.col("title")).alias("section_key"),
            F.coalesce("page_numbers", F.array().cast("array<int>")).alias("page_numbers"),
            F.coalesce("content", F.lit("")).alias("content"),
        )
    )
