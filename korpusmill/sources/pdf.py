"""PDF files to positioned text spans or recognized lines, by a reader the caller gives.

The reader is a plain function, so a task handles one file at a time, and
whatever library it needs is imported on the executors only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korpusmill.operators.layout import checked_pdf_path

# (file content, first page, last page or None) -> dicts with the columns of SPANS but doc_id.
SpanReader = Callable[[bytes, int, "int | None"], Iterator[dict]]

SPANS = pa.schema(
    [
        ("page", pa.int32()), ("page_count", pa.int32()), ("block_type", pa.int32()), ("block_no", pa.int32()),
        ("line_in_block", pa.int32()), ("span_no", pa.int32()), ("text", pa.string()), ("size", pa.float64()),
        ("flags", pa.int32()), ("font", pa.string()), ("x0", pa.float64()), ("x1", pa.float64()),
        ("line_x0", pa.float64()), ("line_y0", pa.float64()), ("page_x0", pa.float64()), ("page_x1", pa.float64()),
    ]
)
_DDL = (
    "doc_id string, page int, page_count int, block_type int, block_no int, line_in_block int, span_no int, "
    "text string, size double, flags int, font string, x0 double, x1 double, line_x0 double, line_y0 double, "
    "page_x0 double, page_x1 double"
)


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """path and content of PDF files; a path that is not a PDF is an error."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(checked_pdf_path(F.col("path")).alias("path"), "content")


def read_spans(
    files: DataFrame, reader: SpanReader, page_from: int = 1, page_to: int | None = None,
    rows_per_batch: int = 10_000,
) -> DataFrame:
    """Spans of all files, read in small batches; only the pages asked for are opened."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                rows = []
                for span in reader(content.as_py(), max(1, page_from), page_to):
                    rows.append(span)
                    if len(rows) == rows_per_batch:
                        yield _batch(path, rows)
                        rows = []
                if rows:
                    yield _batch(path, rows)

    return files.select("path", "content").mapInArrow(read, _DDL)


def _batch(path: str, rows: list[dict]) -> pa.RecordBatch:
    spans = pa.RecordBatch.from_pylist(rows, schema=SPANS)
    doc = pa.array([path] * len(rows), pa.string())
    return pa.RecordBatch.from_arrays([doc, *spans.columns], names=["doc_id", *SPANS.names])


def toc_page_lines(spans: DataFrame, toc_pages: DataFrame) -> DataFrame:
    """Raw lines of the pages named as tables of contents (doc_id, toc_page)."""
    on_toc = spans.join(toc_pages, (spans["doc_id"] == toc_pages["doc_id"]) & (spans["page"] == toc_pages["toc_page"]))
    on_toc = on_toc.where("block_type = 0").drop(toc_pages["doc_id"])
    parts = F.array_sort(F.collect_list(F.struct(F.col("span_no").alias("o"), F.col("text").alias("t"))))
    lines = on_toc.groupBy("doc_id", "toc_page", "block_no", "line_in_block").agg(F.array_join(parts["t"], "").alias("text"))
    order = F.shiftleft(F.col("block_no").cast("bigint"), 20) + F.col("line_in_block")
    return lines.select("doc_id", "toc_page", order.alias("line_no"), "text")


def document_names(files: DataFrame) -> DataFrame:
    """doc_id, source_name and stem of each file."""
    name = F.regexp_extract("path", r"([^/]+)\z", 1)
    return files.select(
        F.col("path").alias("doc_id"), name.alias("source_name"), F.regexp_replace(name, r"(?i)\.pdf\z", "").alias("stem")
    )
