"""Match the sections of a document's two sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.functions.text import ascii_digits
from korpusmill.operators.dedupe import KEY, section_order
from korpusmill.operators.ordering import row_number_in_ranges
from korpusmill.session import shared_folder, store


def key_order(key: Column) -> Column:
    """Dotted keys as number lists, 2 before 10; the numbers may have any length."""

    def number(part: Column) -> Column:
        digits = F.ltrim(ascii_digits(part), F.lit("0"))
        return F.struct(F.length(digits).alias("n"), digits.alias("digits"))

    return F.transform(F.split(key, r"\."), number)


def number_sections(sections: DataFrame) -> DataFrame:
    """Add ``place``, the position on the document side in output order.

    What is sorted has no texts. It is dealt by ranges of the whole sort key,
    so a document whose sections all begin on one page is split, too. Sampling
    the ranges, dealing them and the join back all read the sections, so these
    are stored first.
    """
    return _number_stored(store(sections, shared_folder(sections.sparkSession, "unplaced")))


def _number_stored(sections: DataFrame) -> DataFrame:
    narrow = sections.select(*KEY, *(c.alias(f"_by{i}") for i, c in enumerate(section_order())))
    by = [F.col(f"_by{i}") for i in range(len(section_order()))]
    placed = row_number_in_ranges(narrow, ["doc_id", "side"], by, "place")
    return sections.join(placed.select(*KEY, "place"), KEY)


def _sides(matched: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Full outer join of left and right on ``keys``; the last of equal keys counts.

    Both sides come from one table, so one aggregate does it, with one shuffle.
    """
    value = F.struct("section_no", "name", "section_key", "page_numbers", "content")
    return matched.groupBy(*keys).agg(
        *[
            F.max_by(value, F.when(F.col("side") == side, order)).alias(side)
            for side in ("left", "right")
        ]
    )


def pair_sections(sections: DataFrame) -> DataFrame:
    """(doc_id, pair_id, left, right) from both sides' deduplicated sections.

    By section key where a document has any, dropping sections without one;
    by position where it has none. The sections are stored once for both.
    """
    sections = store(sections, shared_folder(sections.sparkSession, "unpaired"))
    keyed_docs = sections.where("section_key is not null").select("doc_id").distinct()
    order = F.struct(*section_order()[:3], F.length("content") * -1, F.col("position"))
    by_key = _sides(
        sections.where("section_key is not null").withColumn("pair_id", F.col("section_key")),
        ["doc_id", "pair_id"], order,
    )
    unkeyed = _number_stored(sections.join(keyed_docs, "doc_id", "left_anti"))
    by_place = _sides(unkeyed, ["doc_id", "place"], F.col("place"))
    return by_key.select("doc_id", "pair_id", key_order(F.col("pair_id")).alias("pair_order"), "left", "right").unionByName(
        by_place.select(
            "doc_id",
            F.col("place").cast("string").alias("pair_id"),
            key_order(F.col("place").cast("string")).alias("pair_order"),
            "left",
            "right",
        )
    )


def dropped_by_pairing(sections: DataFrame) -> DataFrame:
    """Per document, how many sections pairing leaves out for want of a key."""
    return (
        sections.groupBy("doc_id")
        .agg(F.count("section_key").alias("_keyed"), F.count_if(F.col("section_key").isNull()).alias("dropped"))
        .where("_keyed > 0")
        .select("doc_id", "dropped")
    )
