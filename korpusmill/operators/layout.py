"""Positioned text spans to document lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korpusmill.functions.text import normalize_space, strip_space

PAGE_SHIFT = 20  # line_no = page, then the line's place on its page


def page_range(page_from: Column, page_to: Column, total: Column) -> Column:
    """(first, last) page to read, clamped to the document; (1, 0) for an empty one.

    A range that ends before it starts is an error.
    """
    first = F.greatest(F.lit(1), F.coalesce(page_from, F.lit(1))).cast("int")
    last = F.least(total, F.coalesce(page_to, total)).cast("int")
    pages = F.struct(first.alias("page_from"), last.alias("page_to"))
    empty = F.struct(F.lit(1).alias("page_from"), F.lit(0).alias("page_to"))
    message = F.concat_ws(" ", F.lit("invalid page range"), first, F.lit("to"), last, F.lit("of"), total)
    return (
        F.when(total <= 0, empty)
        .when(first > last, F.raise_error(message).cast("struct<page_from:int,page_to:int>"))
        .otherwise(pages)
    )


def checked_pdf_path(path: Column) -> Column:
    """The path itself if it ends in .pdf; an error otherwise."""
    return F.when(F.lower(path).endswith(".pdf"), path).otherwise(
        F.raise_error(F.concat(F.lit("not a PDF: "), path)).cast("string")
    )


def in_clip(side: str, gutter_ratio: float = 0.02) -> Column:
    """Whether a span's middle lies in the left or right half of its page.

    The gutter around the page's middle belongs to neither.
    """
    width = F.col("page_x1") - F.col("page_x0")
    middle = F.col("page_x0") + width / 2
    gutter = width * F.lit(gutter_ratio)
    center = (F.col("x0") + F.col("x1")) / 2
    if side == "left":
        return center.between(F.col("page_x0"), middle - gutter)
    if side == "right":
        return center.between(middle + gutter, F.col("page_x1"))
    raise ValueError(side)


def lines_from_spans(
    spans: DataFrame, side: str | None = None, gutter_ratio: float = 0.02, by_position: bool = False,
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Lines with text, weight and size from text spans (doc, page, block, line, span).

    ``by_position`` orders a page's lines top to bottom, then left to right;
    otherwise the reader's order is kept.
    """
    kept = spans.where(F.col("block_type") == 0)
    if side is not None:
        kept = kept.where(in_clip(side, gutter_ratio))
    text = strip_space(F.coalesce("text", F.lit("")))
    font = F.lower(F.coalesce("font", F.lit("")))
    bold = (F.col("flags").bitwiseAND(16) != 0) | font.contains("bold") | font.contains("bd")
    parts = F.array_sort(F.collect_list(F.when(text != "", F.struct(F.col("span_no").alias("o"), text.alias("t")))))
    lines = kept.groupBy(*keys, "page", "block_no", "line_in_block").agg(
        normalize_space(F.array_join(parts["t"], " ")).alias("text"),
        (F.count_if(bold) >= F.greatest(F.lit(1), F.floor(F.count("*") / 2))).alias("is_bold"),
        F.median("size").alias("font_size"),
        F.min("line_x0").alias("x0"),
        F.min("line_y0").alias("y0"),
    )
    lines = lines.where(F.col("text") != "")
    place = [F.col("block_no"), F.col("line_in_block")]
    if by_position:
        place = [(F.col("y0") * 10).cast("int"), (F.col("x0") * 10).cast("int"), *place]
    on_page = F.row_number().over(Window.partitionBy(*keys, "page").orderBy(*place))
    return lines.select(
        *keys,
        F.lit(side or "full").alias("side"),
        (F.shiftleft(F.col("page").cast("bigint"), PAGE_SHIFT) + on_page).alias("line_no"),
        "page", "text", "is_bold", "font_size",
    )
