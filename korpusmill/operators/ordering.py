"""Running counts, ranks and ordered concatenation inside groups of any size.

A plain window puts a whole group into one task. Here a group is cut into
blocks of its order column: rows are only ever sorted within a block, and the
blocks' totals, one row each, carry the running value across.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from korpusmill.functions.text import normalize_multiline
from korpusmill.session import shared_folder, store

BLOCK = 4096


def with_block(df: DataFrame, order: str, size: int = BLOCK) -> DataFrame:
    """Add the block number. Steps that find it share one shuffle of the rows."""
    return df if "_block" in df.columns else df.withColumn("_block", F.floor(F.col(order) / size).cast("bigint"))


def block_offsets(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per block, ``_n`` summed over the group's earlier blocks and over all of them."""
    group = Window.partitionBy(*keys)
    before = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint")).withColumn(
        "_total", F.sum("_n").over(group).cast("bigint")
    ).drop("_n")


def running_count(
    df: DataFrame, keys: list[str], order: str, flag: Column, out: str,
    inclusive: bool = True, total: str | None = None, counts: DataFrame | None = None, block: int = BLOCK,
) -> DataFrame:
    """How many rows of the group up to this one (or before it) have the flag.

    ``counts`` may give the number of flagged rows (``_n``) per block if it is
    known more cheaply; its other columns join the rows and may be used in ``flag``.
    """
    marked = with_block(df, order, block)
    if counts is None:
        counts = marked.groupBy(*keys, "_block").agg(F.sum(flag.cast("int")).alias("_n"))
    upto = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    local = F.coalesce(F.sum("_flag").over(upto), F.lit(0))
    counted = (
        marked.join(block_offsets(counts, keys), [*keys, "_block"])
        .withColumn("_flag", flag.cast("int"))
        .withColumn(out, (F.col("_before") + local).cast("bigint"))
        .drop("_flag", "_before")
    )
    counted = counted.withColumnRenamed("_total", total) if total else counted.drop("_total")
    return counted if "_block" in df.columns else counted.drop("_block")


def row_number_in_blocks(
    df: DataFrame, keys: list[str], block: Column, order: list[Column], out: str
) -> DataFrame:
    """Position in the group. ``block`` must never fall as ``order`` rises."""
    marked = df.withColumn("_block", block)
    counts = marked.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    offsets = block_offsets(counts, keys).drop("_total")
    local = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order))
    joined = marked.join(offsets, [*keys, "_block"])
    return joined.withColumn(out, F.col("_before") + local).drop("_block", "_before")


def in_ranges(df: DataFrame, keys: list[str], order: list[Column], ranges: int | None = None) -> DataFrame:
    """A stored table with ``_block``: ranges of group and sort key between splitters that Spark samples.

    Block numbers never fall as groups and sort keys rise, and a group of any
    size is split wherever its sort keys differ.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *map(F.col, keys), *order)
    return store(dealt.withColumn("_block", F.spark_partition_id().cast("bigint")), shared_folder(spark, "ranges"))


def row_number_in_ranges(df: DataFrame, keys: list[str], order: list[Column], out: str, ranges: int | None = None) -> DataFrame:
    """Position in the group, however many of its rows share a page or any other part of the sort key."""
    return row_number_in_blocks(in_ranges(df, keys, order, ranges), keys, F.col("_block"), order, out)


def join_in_blocks(df: DataFrame, keys: list[str], order: str = "line_no", block: int = BLOCK) -> DataFrame:
    """Per group and block: its lines in order as one text (``_piece``), and its pages (``_pages``)."""
    lines = with_block(df, order, block).withColumn("_line", normalize_multiline(F.col("text")))
    pieces = lines.groupBy(*keys, "_block").agg(
        F.sort_array(
            F.collect_list(F.when(F.col("_line") != "", F.struct(F.col(order).alias("o"), F.col("_line").alias("t"))))
        ).alias("_lines"),
        F.collect_set("page").alias("_pages"),
    )
    return pieces.withColumn("_piece", F.array_join(F.col("_lines.t"), "\n")).drop("_lines")


def join_blocks(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Per group, its blocks' pieces as one text, and its sorted pages."""
    return pieces.groupBy(*keys).agg(
        F.array_join(
            F.sort_array(
                F.collect_list(
                    F.when(F.col("_piece") != "", F.struct(F.col("_block").alias("o"), F.col("_piece").alias("t")))
                )
            )["t"],
            "\n",
        ).alias("content"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("_pages")))).alias("page_numbers"),
    )


def concat_lines(df: DataFrame, keys: list[str], order: str = "line_no", block: int = BLOCK) -> DataFrame:
    """Per group: its lines in order as one text, and its sorted pages.

    Lines are joined per block first, so a long group reaches its last task as
    a few ready pieces.
    """
    return join_blocks(join_in_blocks(df, keys, order, block), keys)
