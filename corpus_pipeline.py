"""Training documents in five stages: quality, repeated lines, near duplicates, test items, pieces.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
one before kept. All but the last return the columns of documents. Every
stage's table is written to the shared folder and read again, so a lost
executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korpusmill.llm import decontaminate, line_dedup, near_dedup, quality, sp_encoding
from korpusmill.llm.common import read
from korpusmill.session import shared_folder, store


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.drop_low_quality(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that an earlier document holds; ``n_chars`` follows the text. No document goes."""
    cut = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return cut.select(*(new[c].alias(c) if c in new else c for c in docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, also an edited one."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each text, and whether they decode to it."""
    return sp_encoding.encode_documents(docs).select("doc_id", "lang", "source", "n_chars", "n_pieces", "ids", "lossless")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_test_items),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier is trained and the pieces are drawn by hash; SQL expresses neither. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), shared_folder(spark, "stage-" + name.split(" ")[0].lower()))
    return docs
