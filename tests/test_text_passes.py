"""What queries on lines pay for: each line's header tests once, each section's language once."""

import re

from pyspark.sql import functions as F

from korpusmill.functions.headers import LEGAL_HEADER, header_flags, stripped
from korpusmill.functions.language import CYRILLIC, script_language
from korpusmill.functions.text import WS, normalize_space
from korpusmill.operators import sections
from korpusmill.operators.toc import _ends_entry

LINES = "doc_id long, side string, line_no long, page int, text string, is_bold boolean, font_size double"


def _times(df, pattern):
    return df._jdf.queryExecution().optimizedPlan().toString().count(pattern)


def test_header_tests_run_once_a_line(spark):
    rows = [(1, "left", n, n // 3 + 1, f"{n}. Title {n}" if n % 4 == 1 else f"words {n}", False, 10.0) for n in range(11)]
    lines = spark.createDataFrame(rows, LINES)
    assert _times(sections._pieces(lines, 4096), LEGAL_HEADER[:25]) == 1
    whole, cut = (sections.split_sections(lines, b).orderBy("section_no").collect() for b in (4096, 3))
    assert whole == cut
    assert [r["section_no"] for r in whole] == [0, 1, 2, 3] and whole[1]["content"] == "1. Title 1\nwords 2\nwords 3\nwords 4"
    assert [r["page_numbers"] for r in whole] == [[1], [1, 2], [2, 3], [4]]


def test_blank_start_is_dropped_only_where_a_header_follows(spark):
    rows = [(d, "left", n, 1, t, False, 10.0) for d, texts in ((1, [" ", "1. Title"]), (2, [" ", ""])) for n, t in enumerate(texts)]
    for block in (1, 4096):
        got = sections.split_sections(spark.createDataFrame(rows, LINES), block).orderBy("doc_id", "section_no").collect()
        assert [(r["doc_id"], r["section_no"], r["content"]) for r in got] == [(1, 1, "1. Title"), (2, 0, "")]


def test_letters_are_counted_in_runs(spark):
    texts = ["abв", "aбв", "ab бв", "ёжik ok", "Ёé", "é ﬁ ж", "×x÷ я", "𝔸a б", "a" * 9 + " б" * 10, "ªº ж"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(script_language(F.col("t")).alias("l"), F.regexp_count("t", F.lit(CYRILLIC)).alias("c"), F.regexp_count("t", F.lit(r"\p{IsLatin}")).alias("n")).collect()
    assert [r["l"] for r in got] == ["ru" if r["c"] >= r["n"] else "en" for r in got]
    plan = spark.range(1).select(script_language(F.concat(F.lit("a б"), F.col("id").cast("string"))))
    assert _times(plan, "regexp_count") == 0 and _times(plan, "size(regexp_extract_all") == 0


def test_blanks_and_breaks(spark):
    texts = ["a b", "a\nb", "\na b\n", " a", "a \nb", "a\n b", "a\n\nb", "a  b", "a\tb", "a b\nc", "", "\n", " ", "a\xa0\nb", "a\x85b", None]
    space = re.compile("[\t-\r\x1c-\x20\x85\xa0  -     　]+")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(normalize_space(F.col("t"))).collect()] == [space.sub(" ", t or "").strip(" ") for t in texts]
    assert [r[0] for r in df.select(stripped(F.col("t"))).collect()] == [(t or "").strip() for t in texts]


def test_last_word_ends_an_entry(spark):
    lines = ["Part 1", "Part 12345", "Part .... 9999", "7", "Part 1a", "Part ٣", "Part a1", "Part", "a b 12"]
    df = spark.createDataFrame([(t,) for t in lines], "t string")
    got = df.select(_ends_entry(F.col("t")).alias("g"), F.col("t").rlike(r"[^ ] \p{Nd}{1,4}\z").alias("w")).collect()
    assert [r["g"] for r in got] == [r["w"] for r in got]
