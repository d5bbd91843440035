import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table with the columns of documents and some whose names clash with results."""

    def make(rows):
        wide = [(d, t, "en", None, len(t) if t else None, -1.0, "x", False) for d, t in rows]
        return spark.createDataFrame(wide, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept_text string, kept boolean")

    return make


@pytest.fixture
def save(tmp_path):
    """Write tables into a folder like the given ones; returns its path."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
