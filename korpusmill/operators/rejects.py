"""Rows that cannot be worked on, set apart with their reasons instead of ending the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.operators.layout import page_range
from korpusmill.session import shared_folder, store


def path_problem(path: Column) -> Column:
    """Why ``checked_pdf_path`` would fail, or null."""
    return F.when(path.isNull(), "no path").when(~F.lower(path).endswith(".pdf"), F.concat(F.lit("not a PDF: "), path))


def range_problem(page_from: Column, page_to: Column, total: Column) -> Column:
    """Why ``page_range`` would fail, or null."""
    first, last = F.greatest(F.lit(1), F.coalesce(page_from, F.lit(1))), F.least(total, F.coalesce(page_to, total))
    message = F.concat_ws(" ", F.lit("invalid page range"), first.cast("int"), F.lit("to"), last.cast("int"), F.lit("of"), total)
    return F.when(total.isNull(), "unknown number of pages").when((total > 0) & (first > last), message)


def toc_page_problem(toc_page: Column, total: Column) -> Column:
    """Why ``check_toc_pages`` would fail, or null."""
    message = F.concat_ws(" ", F.lit("TOC page out of range:"), toc_page, F.lit("of"), total)
    return F.when(total.isNull(), "unknown number of pages").when(toc_page.isNull(), "no TOC page").when((toc_page < 1) | (toc_page > total), message)


def split_rejected(rows: DataFrame, *problems: Column) -> tuple[DataFrame, DataFrame]:
    """The rows without a problem, and the others with all their reasons in ``reason``.

    Rows are judged and written in one pass; both tables are read from it.
    """
    reason = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    judged = store(rows.withColumn("reason", reason), shared_folder(rows.sparkSession, "judged"))
    return judged.where(F.col("reason").isNull()).drop("reason"), judged.where(F.col("reason").isNotNull())


def accept_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (doc_id, path, page_from, page_to, page_count): the documents to read with their clamped ranges, and the rejected rows."""
    asked = [F.col(c) for c in ("page_from", "page_to", "page_count")]
    good, bad = split_rejected(requests, path_problem(F.col("path")), range_problem(*asked))
    others = [c for c in good.columns if c not in ("page_from", "page_to")]
    return good.withColumn("_range", page_range(*asked)).select(*others, "_range.page_from", "_range.page_to"), bad


def accept_toc_pages(toc_pages: DataFrame, page_counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, toc_page) of pages that their document has, and the rejected rows; a page of an unknown document is one."""
    joined = toc_pages.select("doc_id", "toc_page").join(page_counts.select("doc_id", "page_count"), "doc_id", "left")
    good, bad = split_rejected(joined, toc_page_problem(F.col("toc_page"), F.col("page_count")))
    return good.select("doc_id", "toc_page"), bad
