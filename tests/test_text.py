import hashlib
import random
import re
import sys
import time
import unicodedata

from pyspark.sql import functions as F

from korpusmill.functions import headers, text
from korpusmill.functions.language import detect_language, lang_to_folder

SPACES = [c for c in map(chr, range(0x10000)) if c.isspace()]
RAGGED = [
    None, "", "   ", "a", " a  b ", "a \n b", "a\n\n b\t\tc", "x" + "".join(SPACES) + "y", "a\x85b\x0bc\x1cd", "a   b", "  \n",
    "many   spaces    here", "tab\t tab", "nbsp\xa0 \xa0x", "a\r\nb\r c", " \ta \t\n\t b", "one two three",
]


def test_normalize_space_matches_unicode_whitespace(apply):
    want = [" ".join((v or "").split()) for v in RAGGED]
    got = apply(text.normalize_space, RAGGED)
    assert got == want
    assert apply(text.normalize_space, got) == got


def test_normalize_multiline(apply):
    want = ["\n".join(" ".join(line.split()) for line in (v or "").splitlines() if line.split()) for v in RAGGED]
    got = apply(text.normalize_multiline, RAGGED)
    assert got == want
    assert apply(text.normalize_multiline, got) == got


def test_normalization_of_any_space_between_and_at_ends(apply):
    spaces = ["", " ", *SPACES, chr(0x200B), chr(0x2014), chr(0x180E)]
    values = [f"a{x}{y}b{y}" for x in spaces for y in spaces]
    assert apply(text.normalize_space, values) == [" ".join(v.split()) for v in values]
    assert apply(text.normalize_multiline, values) == ["\n".join(" ".join(p.split()) for p in v.splitlines() if p.split()) for v in values]


def test_plain_lines_need_no_pattern(spark):
    """Lines with single blanks must cost less than the pattern for runs of white space alone."""
    lines = spark.range(20000).select(F.concat_ws(" ", *(F.concat(F.lit("word"), (F.col("id") * i).cast("string")) for i in range(1, 30))).alias("t")).cache()
    lines.count()
    inner = rf"[{text.WS}&&[^{text._BREAKS}]]*+"
    pattern = F.regexp_replace("t", rf" ?[{text.WS}&&[^ {text._BREAKS}]]{inner}| {{2,}}+{inner}", " ")

    def seconds(c):
        spent = []
        for _ in range(4):
            start = time.time()
            lines.select(F.sum(F.hash(c))).collect()
            spent.append(time.time() - start)
        return min(spent)

    assert seconds(text.normalize_multiline(F.col("t"))) < 0.7 * seconds(pattern)
    lines.unpersist()


def test_sha1_norm(apply):
    values = ["  Ысык-Көл \n", "ысык-көл", "Other"]
    want = [hashlib.sha1(" ".join(v.split()).lower().encode()).hexdigest() for v in values]
    assert apply(text.sha1_norm, values) == want
    assert want[0] == want[1]


def test_short_about(apply):
    assert apply(text.short_about, ["", None, "a" * 280, "a" * 281]) == [None, None, "a" * 280, "a" * 280 + "…"]


def test_sanitize_filename(apply):
    values = ['a<>:"|?*b', " . ", "x" * 200, "a/b\\c"]
    assert apply(text.sanitize_filename, values) == ["a_b", "untitled", "x" * 160, "a_b_c"]
    assert apply(lambda c: text.sanitize_filename(c, 140, None), values) == ["a_b", "", "x" * 140, "a_b_c"]


def test_footer_is_cut_in_the_tail_only(apply):
    body = "слово " * 100
    tail = body + "Все права защищены. Телефон: 1"
    early = "cookie " + "w" * 400
    inside_word = "б" * 300 + " тип связи"
    emoji = "😀" * 300 + "© 2024 Банк"
    got = apply(text.trim_footer_noise, [tail, early, inside_word, emoji, "© 2024 " + "a" * 292])
    assert got == [body.strip(), early, "б" * 300 + " т", "😀" * 300, "© 2024 " + "a" * 292]


def test_footer_tail_starts_at_a_truncated_double(apply):
    for n in (330, 340, 650):
        start = int(n * 0.7)
        for at in (start - 1, start):
            page = "x" * at + "cookie" + "x" * (n - at - 6)
            assert len(page) == n
            assert apply(text.trim_footer_noise, [page]) == [page if at < start else "x" * at]


def test_detect_language(apply):
    values = ["", " \xa0", "Өлкө", "Привет", "hello", "12345", "Привет hi", "long english текст", "über", None]
    assert apply(detect_language, values) == ["ru", "ru", "ky", "ru", "en", "ru", "ru", "en", "en", "ru"]


def test_lang_to_folder(apply):
    assert apply(lang_to_folder, ["RU", "ky", "en", "de", None]) == ["russian", "kyrgyz", "english", "other", "other"]


def test_longer_text_prefers_the_second_on_a_tie(spark):
    df = spark.createDataFrame([("ab", "cd"), ("abc", "d"), (None, "")], "a string, b string")
    assert [r[0] for r in df.select(text.longer_text(F.col("a"), F.col("b"))).collect()] == ["cd", "abc", ""]


def test_section_keys_backtrack_on_bare_numbers(apply):
    values = ["1. General", "1.2) Terms", "12345", "1.", "x 1", "3 ab", "٣. Терм", "1.a"]
    assert apply(headers.section_key, values) == ["1", "1.2", "123", None, None, "3", "٣", "1"]
    assert apply(headers.toc_section_key, ["1.a", "12", "7"]) == ["1", "1", None]


def test_section_keys_have_no_depth_limit_and_match_a_plain_pattern(apply):
    deep = ".".join(["1"] * 600)
    rng = random.Random(1)
    junk = ["".join(rng.choice("12. )a\n") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    values = [deep + " Title", deep, "1..2 text", "1.2..3 text", "1.2.3", "12.3", "1.23", "." + deep, "1" * 3000 + " x y", "1.2. " + "x" * 220, "1 " + "x" * 222, *junk]
    for function, rest in ((headers.section_key, r"[^\n]{2,220}"), (headers.toc_section_key, r"[^\n]+?")):
        plain = [re.match(rf"^(\d+(?:\.\d+)*)\s*[.)]?\s*{rest}\s*\Z", v.strip()) for v in values]
        assert apply(function, values) == [m and m[1] for m in plain]


def test_ascii_digits(apply):
    nd = [c for c in map(chr, range(0x10000)) if unicodedata.category(c) == "Nd"]
    assert apply(text.ascii_digits, ["".join(nd)]) == ["".join(str(unicodedata.digit(c)) for c in nd)]


def test_whitespace_class_covers_python(spark):
    matched = spark.range(0x10000).where("id < 55296 or id > 57343").select(F.col("id"))
    chars = matched.select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    found = {r[0] for r in chars.where(F.col("c").rlike(text.WS)).collect()}
    assert found == {i for i in range(0x10000) if re.match(r"\s", chr(i))}
    assert sys.maxunicode > 0x10000


def test_header_quality(apply):
    values = ["", "Ends here.", "two words", "ALL CAPS TITLE", "a b c d", "1 2 3"]
    assert apply(headers.header_quality, values) == [0.0, 0.2, 0.35, 1.0, 0.5, 0.5]


def header(apply_to, line, bold=False, size=10.0, threshold=12.0):
    always, by_size = apply_to(line, bold)
    return always or (threshold > 0 and size >= threshold and by_size)


def test_header_rules(spark):
    def flags(line, bold):
        df = spark.createDataFrame([(line, bold)], "t string, b boolean")
        return df.select(*headers.header_flags(F.col("t"), F.col("b"))).first()

    assert header(flags, "Статья 5")
    assert header(flags, "приложение к договору")
    assert header(flags, "ГЛАВА IV. Общие")
    assert header(flags, "1. ОБЩИЕ ПОЛОЖЕНИЯ")
    assert not header(flags, "1. a")
    assert not header(flags, "Термин — определение", bold=True, size=20)
    assert header(flags, "any line", size=12.0)
    assert not header(flags, "any line", size=12.0, threshold=0)
    assert not header(flags, "x" * 241, size=12.0)
    assert header(flags, "ОБЩИЕ ПОЛОЖЕНИЯ БАНКА", bold=True)
    assert not header(flags, "Общие положения банка", bold=True)
    assert not header(flags, "")
