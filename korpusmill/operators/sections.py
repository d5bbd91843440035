"""Split document lines into sections at their headers.

Line tables carry doc_id, side, line_no, page, text, is_bold, font_size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korpusmill.functions.headers import header_flags, section_key, stripped
from korpusmill.functions.text import normalize_space
from korpusmill.operators.ordering import BLOCK, block_offsets, join_blocks, join_in_blocks, with_block
from korpusmill.session import shared_folder, store

SIDE = ["doc_id", "side"]
UNTITLED = "Full Document"


def _flagged(lines: DataFrame, block: int) -> DataFrame:
    always, by_size = header_flags(F.col("_stripped"), F.col("is_bold"))
    read = with_block(lines, "line_no", block).withColumn("_stripped", stripped(F.col("text")))
    return read.withColumns({"_always": always, "_by_size": by_size}).drop("_stripped")


def _thresholds(sizes: DataFrame) -> DataFrame:
    """From line counts ``_n`` per font size."""
    positive = F.when(F.col("font_size") > 0, F.col("font_size"))
    half = F.lit(0.5).cast("double")
    counted = sizes.groupBy(*SIDE).agg(
        F.coalesce(F.sum(F.when(positive.isNotNull(), F.col("_n"))), F.lit(0)).alias("n_sizes"),
        F.percentile(positive, half, F.col("_n")).alias("_median"),
    )
    threshold = F.when(F.col("n_sizes") >= 12, F.col("_median") * F.lit(1.2).cast("double")).otherwise(0.0)
    return counted.select(*SIDE, "n_sizes", threshold.cast("double").alias("threshold"))


def font_thresholds(lines: DataFrame) -> DataFrame:
    """Per document side, the size from which a font marks a header; 0 turns the rule off.

    Sizes are counted first, so a long document reaches the median as a short
    histogram.
    """
    return _thresholds(lines.groupBy(*SIDE, "font_size").agg(F.count("*").alias("_n")))


def _is_header() -> Column:
    large = (F.col("threshold") > 0) & (F.col("font_size") >= F.col("threshold"))
    return F.col("_always") | (large & F.col("_by_size"))


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block of lines, the threshold of its side and whether the side has no other block.

    Font sizes alone are counted for it: no text is looked at.
    """
    sized = lines.groupBy(*SIDE, "_block", "font_size").agg(F.count("*").alias("_n"))
    alone = sized.groupBy(*SIDE).agg((F.min("_block") == F.max("_block")).alias("_alone"))
    known = _thresholds(sized).drop("n_sizes").join(alone, SIDE)
    return sized.select(*SIDE, "_block").distinct().join(known, SIDE)


def with_headers(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """Add ``is_header``.

    Thresholds reach the lines by block, so a long document's lines are never
    joined on its id alone.
    """
    flagged = _flagged(lines, block)
    return (
        flagged.join(_blocks(with_block(lines, "line_no", block)).drop("_alone"), [*SIDE, "_block"])
        .withColumn("is_header", _is_header())
        .select(*lines.columns, "is_header")
    )


def whole_document(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """One section per document side. Its blocks meet by document, so a join on that moves no text again."""
    pieces = join_in_blocks(lines, SIDE, block=block).repartition("doc_id")
    return join_blocks(pieces, SIDE).select(
        *SIDE,
        F.lit(0).cast("bigint").alias("section_no"),
        F.lit(UNTITLED).alias("name"),
        F.lit(None).cast("string").alias("section_key"),
        "page_numbers",
        "content",
    )


def split_sections(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """One section per header with the lines up to the next header.

    Lines before the first header form section 0. It is dropped when blank,
    unless the document has no header at all.

    Lines are dealt once, by side and block, and joined to pieces there. Of a
    side with one block these are its sections; only those of longer sides meet
    across blocks.
    """
    pieces = store(_pieces(lines, block), shared_folder(lines.sparkSession, "section-pieces"))
    columns = [*SIDE, "section_no", "_headers", "content", "page_numbers"]
    whole = pieces.where("_alone").select(
        *SIDE, F.col("_part").alias("section_no"), F.col("_n").alias("_headers"),
        F.col("_piece").alias("content"), F.sort_array("_pages").alias("page_numbers"),
    )
    # Offsets are a row a block, and stored so that Spark knows how few they are.
    split = pieces.where("not _alone")
    offsets = block_offsets(split.select(*SIDE, "_block", "_n").distinct(), SIDE)
    offsets = store(offsets, shared_folder(lines.sparkSession, "section-offsets"))
    numbered = split.join(offsets, [*SIDE, "_block"]).withColumn("section_no", F.col("_before") + F.col("_part"))
    across = join_blocks(numbered.withColumnRenamed("_total", "_headers"), [*SIDE, "section_no", "_headers"])
    bodies = whole.select(columns).unionByName(across.select(columns))
    kept = bodies.where((F.col("section_no") > 0) | (F.col("content") != "") | (F.col("_headers") == 0))
    title = F.when(F.col("section_no") > 0, F.substring_index("content", "\n", 1))
    return kept.select(
        *SIDE,
        "section_no",
        F.coalesce(title, F.lit(UNTITLED)).alias("name"),
        section_key(title).alias("section_key"),
        "page_numbers",
        "content",
    )


def _pieces(lines: DataFrame, block: int) -> DataFrame:
    """Per block, its lines before the first header and from each header on, numbered from 0 (``_part``), with its headers (``_n``)."""
    group = Window.partitionBy(*SIDE, "_block")
    upto = group.orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = _flagged(lines, block).join(_blocks(with_block(lines, "line_no", block)), [*SIDE, "_block"])
    flag = known.withColumn("_header", _is_header())
    count = F.sum(F.col("_header").cast("int"))
    parts = flag.withColumn("_part", count.over(upto)).withColumn("_n", count.over(group))
    # A header is one line of content, whatever breaks it holds.
    text = F.when(F.col("_header"), normalize_space(F.col("text"))).otherwise(F.col("text"))
    return join_in_blocks(parts.withColumn("text", text), [*SIDE, "_part", "_n", "_alone"])
