import pytest

from korpusmill.operators.rejects import accept_requests, accept_toc_pages, split_rejected
from pyspark.sql import functions as F

ASKED = "doc_id bigint, path string, page_from int, page_to int, page_count int, note string"
ROWS = [
    (1, "a.pdf", None, None, 5, "x"), (2, "b.PDF", 0, 99, 5, "x"), (3, "c.pdf", 4, 2, 5, "x"), (4, "d.doc", 1, 2, 5, "x"), (5, None, 9, None, 5, None),
    (6, "e.pdf", None, None, 0, "x"), (7, "f.pdf", 1, 1, None, "x"), (8, "pdf", None, None, 1, "x"), (None, "g.pdf", 2, 3, 3, "x"), (1, "a.pdf", None, None, 5, "x"),
]


def test_good_rows_go_on_and_bad_ones_are_told(spark):
    good, bad = accept_requests(spark.createDataFrame(ROWS, ASKED))
    assert sorted(map(str, ((r.doc_id, r.path, r.page_from, r.page_to, r.page_count, r.note) for r in good.collect()))) == sorted(map(str, [
        (1, "a.pdf", 1, 5, 5, "x"), (1, "a.pdf", 1, 5, 5, "x"), (2, "b.PDF", 1, 5, 5, "x"), (6, "e.pdf", 1, 0, 0, "x"), (None, "g.pdf", 2, 3, 3, "x"),
    ]))
    assert {r.doc_id: r.reason for r in bad.collect()} == {
        3: "invalid page range 4 to 2 of 5", 4: "not a PDF: d.doc", 5: "no path; invalid page range 9 to 5 of 5", 7: "unknown number of pages", 8: "not a PDF: pdf",
    }
    assert set(bad.columns) == {"doc_id", "path", "page_from", "page_to", "page_count", "note", "reason"}


def test_contents_pages(spark):
    pages = spark.createDataFrame([(1, 1), (1, 3), (1, 4), (1, 0), (2, 1), (1, None), (None, 1)], "doc_id bigint, toc_page int")
    good, bad = accept_toc_pages(pages, spark.createDataFrame([(1, 3)], "doc_id bigint, page_count int"))
    assert sorted(map(tuple, good.collect())) == [(1, 1), (1, 3)]
    assert sorted((str(r.doc_id), str(r.toc_page), r.reason) for r in bad.collect()) == [
        ("1", "0", "TOC page out of range: 0 of 3"), ("1", "4", "TOC page out of range: 4 of 3"), ("1", "None", "no TOC page"),
        ("2", "1", "unknown number of pages"), ("None", "1", "unknown number of pages"),
    ]


def test_empty_tables_and_one_pass(spark):
    good, bad = accept_requests(spark.createDataFrame([], ASKED))
    assert good.collect() == [] and bad.collect() == []
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def count(v):
        seen.add(1)
        return v

    good, bad = split_rejected(spark.range(10).select(count("id").alias("v")), F.when(F.col("v") > 6, "large"))
    assert good.count() == 7 and bad.count() == 3 and seen.value == 10


@pytest.mark.parametrize("row", [ROWS[2], ROWS[3]])
def test_strict_functions_still_fail(spark, row):
    from korpusmill.operators.layout import checked_pdf_path, page_range

    df = spark.createDataFrame([row], ASKED)
    with pytest.raises(Exception, match="invalid page range|not a PDF"):
        df.select(checked_pdf_path(F.col("path")), page_range(F.col("page_from"), F.col("page_to"), F.col("page_count"))).collect()
