"""Section records and output files from document lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpusmill.functions.language import detect_language, lang_to_folder
from korpusmill.functions.text import sanitize_filename
from korpusmill.operators import naming, pairing
from korpusmill.operators.dedupe import KEY, dedupe_exact, dedupe_sections
from korpusmill.operators.ordering import BLOCK
from korpusmill.operators.sections import split_sections, whole_document
from korpusmill.operators.toc import sections_from_toc, toc_entries, toc_intervals
from korpusmill.session import shared_folder, store

SIDES = ("left", "right")


def _languages(left: str, right: str) -> Column:
    return F.when(F.col("side") == "left", left).otherwise(right)


def _files(sections: DataFrame, lang: Column | None, name: Column, folder: Column | None = None) -> DataFrame:
    """doc_id, folder, file_name and the record of each section."""
    record = naming.section_record(F.col("source_name"), lang)
    out = sections.withColumn("record", record).withColumn("file_name", name)
    routed = folder if folder is not None else lang_to_folder(F.col("record.metadata.language"))
    return out.select("doc_id", "side", "section_no", routed.alias("folder"), "file_name", "record")


def bilingual_files(
    lines: DataFrame, sources: DataFrame, split: bool = True, take: str = "both",
    left_lang: str = "ky", right_lang: str = "ru",
) -> DataFrame:
    """Two-column documents split at header lines.

    ``sources`` names each document: doc_id, source_name, stem; equal stems get
    a suffix. With ``take`` "both" and ``split``, sections of the two sides
    that belong together share the pair id in their names. A side without
    lines counts as one empty section.
    """
    if take in SIDES:
        lines = lines.where(F.col("side") == take)
    sections = split_sections(lines) if split else whole_document(lines)
    sources = naming.unique_stems(sources)
    unique = _with_missing_sides(dedupe_sections(sections), sources, take)
    lang, stem = _languages(left_lang, right_lang), F.col("stem")
    if not split:
        return _files(unique.join(sources, "doc_id"), lang, naming.side_file(stem, lang))
    if take in SIDES:
        key = naming.name_part(F.col("section_key"), F.col("name"))
        return naming.keep_last(
            _files(unique.join(sources, "doc_id"), lang, naming.side_file(stem, lang, key, F.col("name"))),
            "section_no", ("doc_id", "folder", "file_name"),
        )
    pairs = pairing.pair_sections(unique)
    both = F.explode(F.array(*[
        F.struct(F.lit(s).alias("side"), F.col(s).alias("section")) for s in SIDES
    ]))
    rows = pairs.select("doc_id", "pair_id", both.alias("s")).where("s.section is not null")
    rows = rows.select("doc_id", "pair_id", "s.side", "s.section.*").join(sources, "doc_id")
    return _files(rows, lang, naming.side_file(stem, lang, F.col("pair_id"), F.col("name")))


def _with_missing_sides(unique: DataFrame, sources: DataFrame, take: str) -> DataFrame:
    """An empty section for every side that has no lines at all; sections with texts are not dealt for that."""
    wanted = SIDES if take == "both" else (take,)
    expected = sources.select("doc_id", F.explode(F.array(*map(F.lit, wanted))).alias("side"))
    missing = expected.join(unique.select("doc_id", "side").distinct(), ["doc_id", "side"], "left_anti")
    blank = {
        "section_no": F.lit(0).cast("bigint"),
        "name": F.lit("Full Document"),
        "section_key": F.lit(None).cast("string"),
        "page_numbers": F.array().cast("array<int>"),
        "content": F.lit(""),
        "position": F.lit(0).cast("bigint"),
    }
    columns = ["doc_id", "side", *(c for c in blank if c in unique.columns)]
    filled = missing.select("doc_id", "side", *(blank[c].alias(c) for c in columns[2:]))
    return unique.where(F.col("side").isin(*wanted)).select(columns).unionByName(filled)


def without_entries(toc_lines: DataFrame, page_counts: DataFrame, sources: DataFrame) -> DataFrame:
    """The sources whose contents give no entry; ``toc_files`` writes nothing for them."""
    return sources.join(toc_entries(toc_lines, page_counts).select("doc_id").distinct(), "doc_id", "left_anti")


def toc_sections(lines: DataFrame, toc_lines: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Deduplicated sections of documents that state their own contents. Two steps need the intervals, so they are stored."""
    intervals = toc_intervals(toc_entries(toc_lines, page_counts), page_counts)
    intervals = store(intervals, shared_folder(lines.sparkSession, "toc-intervals"))
    return dedupe_exact(sections_from_toc(lines, intervals))


def toc_files(
    lines: DataFrame, toc_lines: DataFrame, page_counts: DataFrame, sources: DataFrame,
    bilingual: bool = False, left_lang: str = "ky", right_lang: str = "ru", take: str = "both", strict: bool = False,
) -> DataFrame:
    """Files of documents split by their table of contents.

    Single-column documents go whole into the folder of their commonest
    language. Two-column ones go by side, where a later file replaces an
    earlier one of the same name; ``take`` may name one side. Documents whose
    contents give no entry have no files: ``without_entries`` lists them, and
    ``strict`` makes them an error.
    """
    if strict:
        lost = without_entries(toc_lines, page_counts, sources).select("doc_id").head(1)
        if lost:
            raise ValueError(f"no contents entries in document {lost[0]['doc_id']}")
    if take in SIDES:
        lines = lines.where(F.col("side") == take)
    sources = naming.unique_stems(sources)
    sections = toc_sections(lines, toc_lines, page_counts)
    key = naming.name_part(F.col("section_key"), F.col("name"))
    if bilingual:
        lang = _languages(left_lang, right_lang)
        files = _files(sections.join(sources, "doc_id"), lang, naming.side_file(F.col("stem"), lang, key, F.col("name")))
        return naming.keep_last(files, "section_no", ("doc_id", "folder", "file_name"))
    # Folders and names need all sections of a document, but not their texts.
    # The language of each is found once, before they are stored.
    spoken = sections.withColumn("_lang", detect_language(F.col("content")))
    stored = store(spoken, shared_folder(sections.sparkSession, "toc-files"))
    folders = naming.majority_language(stored, known="_lang").select("doc_id", F.col("folder").alias("_folder"))
    names = stored.select(*KEY, "position", "name", "section_key").join(sources.select("doc_id", "stem"), "doc_id")
    base = sanitize_filename(F.concat_ws("__", F.col("stem"), key, F.col("name")))
    names = naming.unique_names(names, base, "position", "_name").select(*KEY, "_name")
    named = stored.join(names, KEY).join(folders, "doc_id").join(sources, "doc_id")
    return _files(named, F.col("_lang"), F.concat(F.col("_name"), F.lit(".json")), F.col("_folder"))


def full_files(lines: DataFrame, sources: DataFrame) -> DataFrame:
    """One file per single-column document, in the folder of its language; no contents needed."""
    named = whole_document(lines, BLOCK).join(naming.unique_stems(sources), "doc_id")
    return _files(named, None, F.concat(sanitize_filename(F.col("stem")), F.lit(".json")))
