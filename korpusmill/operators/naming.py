"""Output records and file names of sections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.functions.language import detect_language, lang_to_folder
from korpusmill.functions.text import sanitize_filename
from korpusmill.operators.free_names import MAX_NAME, first_free, with_suffix
from korpusmill.operators.ordering import BLOCK, row_number_in_blocks, row_number_in_ranges


def rag_header(source_name: Column, section_name: Column) -> Column:
    return F.concat(F.lit("[Document: "), source_name, F.lit("]\n[Section: "), section_name, F.lit("]"))


def section_record(source_name: Column, forced_lang: Column | None = None, detect: Callable[[Column], Column] = detect_language) -> Column:
    """source_name, content and metadata of a section row.

    The language is the one given; where it is null or empty, the one that
    ``detect`` finds (by script, unless another detector is given).
    """
    lang = detect(F.col("content"))
    if forced_lang is not None:
        lang = F.coalesce(F.nullif(forced_lang, F.lit("")), lang)
    return F.struct(
        source_name.alias("source_name"),
        F.col("content").alias("content"),
        F.struct(
            F.col("name").alias("section_name"),
            F.array_sort("page_numbers").alias("page_numbers"),
            lang.alias("language"),
            rag_header(source_name, F.col("name")).alias("rag_header"),
        ).alias("metadata"),
    )


def record_json(record: Column) -> Column:
    """One line of JSON with nulls written out."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def name_part(key: Column, name: Column) -> Column:
    """The section key, or the start of the name for sections without one."""
    return F.coalesce(key, F.substring(sanitize_filename(name), 1, 24))


def side_file(stem: Column, lang: Column, key: Column | None = None, name: Column | None = None) -> Column:
    """``stem__lang`` or ``stem__key__lang__name``."""
    parts = [sanitize_filename(stem), lang] if key is None else [sanitize_filename(stem), key, lang, sanitize_filename(name)]
    return F.concat(F.concat_ws("__", *parts), F.lit(".json"))


def unique_names(
    sections: DataFrame, base: Column, order: str, out: str = "file_name", keys: tuple[str, ...] = ("doc_id",),
    dense: bool = True,
) -> DataFrame:
    """Names that differ within a document even when case is ignored.

    In the order given, each row takes the first free one of its base,
    ``base__2``, ``base__3`` and so on; the base is cut so that the suffix
    always fits. ``order`` is unique within the keys; if its numbers are far
    apart (``dense`` false), rows are cut by ranges that Spark samples.

    Only names of one family can clash: those equal but for case and numeric
    suffixes, compared by their first characters, which a cut leaves alone. A
    family with one spelling is numbered in blocks, however large. A family
    with several goes to one task, with its names alone.
    """
    named = sections.withColumn(out, base).withColumn("_low", F.lower(out))
    bare = F.regexp_replace("_low", r"(?:__[0-9]+)+$", "")
    named = named.withColumn("_family", F.substring(bare, 1, MAX_NAME - 20))
    family = [*keys, "_family"]
    mixed = named.groupBy(*family).agg((F.min("_low") != F.max("_low")).alias("_mixed")).where("_mixed")
    simple = named.join(mixed, family, "left_anti")
    spelled = [*keys, "_low"]
    if dense:
        block = F.floor(F.col(order) / BLOCK).cast("bigint")
        simple = row_number_in_blocks(simple, spelled, block, [F.col(order)], "_nth")
    else:
        simple = row_number_in_ranges(simple, spelled, [F.col(order)], "_nth")
    simple = simple.withColumn(out, with_suffix(F.col(out), F.col("_nth"))).drop("_nth")

    clashing = named.join(mixed.drop("_mixed"), family)
    settled = first_free(clashing.select(*keys, F.col(order).alias("_order"), F.col(out).alias("_base")), [*keys])
    settled = settled.select(*keys, F.col("_order").alias(order), F.col("_name").alias("_settled"))
    clashing = clashing.join(settled, [*keys, order]).withColumn(out, F.col("_settled")).drop("_settled")
    return simple.unionByName(clashing).drop("_low", "_family")


def unique_stems(sources: DataFrame) -> DataFrame:
    """Sources of one run whose stems differ: equal ones get suffixes, in the order of a number or a hash of doc_id."""
    place = F.xxhash64("doc_id") if dict(sources.dtypes)["doc_id"] == "string" else F.col("doc_id")
    named = unique_names(sources.withColumn("_place", place), F.col("stem"), "_place", "stem", (), dense=False)
    return named.select(*sources.columns)


def keep_last(files: DataFrame, order: str, keys: tuple[str, ...] = ("folder", "file_name")) -> DataFrame:
    """Of records with one path the last, as if each had overwritten the one before."""
    value = F.struct(*[c for c in files.columns if c not in keys])
    return files.groupBy(*keys).agg(F.max_by(value, F.col(order)).alias("_value")).select(*keys, "_value.*")


def majority_language(sections: DataFrame, detect: Callable[[Column], Column] = detect_language, known: str | None = None) -> DataFrame:
    """Per document the commonest section language and its folder; ties go by name. ``known`` may name a column that has it."""
    lang = F.col(known) if known else detect(F.col("content"))
    counts = sections.groupBy("doc_id", lang.alias("_lang")).agg(F.count("*").alias("_n"))
    return counts.groupBy("doc_id").agg(F.min_by("_lang", F.struct(-F.col("_n"), F.col("_lang"))).alias("language")).select(
        "doc_id", "language", lang_to_folder(F.col("language")).alias("folder")
    )
