import random
import re

import pytest
from pyspark.sql import functions as F

from korpusmill.operators import dedupe, layout, naming, ordering, pairing, sections, toc
from korpusmill.plans import pdf_corpus
from korpusmill.sinks.files import read_section_files, write_section_files

LINE = "doc_id bigint, side string, line_no bigint, page int, text string, is_bold boolean, font_size double"
SECTION = "doc_id bigint, side string, section_no bigint, name string, section_key string, page_numbers array<int>, content string"


def lines_of(spark, rows):
    return spark.createDataFrame(rows, LINE)


def sample_lines(rng, docs=4):
    out = []
    for doc in range(docs):
        for n in range(rng.randint(1, 40)):
            text = rng.choice(["1. Общие положения", "обычный текст строки", "Статья 7", "ещё строка", "2.1 Термины", "а — б"])
            out.append((doc, "left", n, 1 + n // 6, text, False, rng.choice([10.0, 10.0, 13.0])))
    return out


def by_loop(rows):
    """Sections of one document side, one line after the other."""
    sizes = sorted(r[6] for r in rows)
    mid = (sizes[(len(sizes) - 1) // 2] + sizes[len(sizes) // 2]) / 2
    limit = mid * 1.2 if len(sizes) >= 12 else 0
    found, current = [], ["Full Document", [], set()]
    for _, _, _, page, text, _, size in rows:
        numbered = re.match(r"\d", text) and " — " not in text
        if text.startswith("Статья") or numbered or (limit and size >= limit and " — " not in text):
            if current[1]:
                found.append(current)
            current = [text, [], set()]
        current[1].append(text)
        current[2].add(page)
    found.append(current)
    return [(name, "\n".join(body), sorted(pages)) for name, body, pages in found]


@pytest.mark.parametrize("block", [3, 4096])
def test_sections_do_not_depend_on_block_size(spark, block):
    rows = sample_lines(random.Random(5))
    got = sections.split_sections(lines_of(spark, rows), block).collect()
    for doc in range(4):
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.section_no)
        want = by_loop([r for r in rows if r[0] == doc])
        assert [(r.name, r.content, r.page_numbers) for r in mine] == want


def test_sections_keep_every_line(spark):
    rows = sample_lines(random.Random(8), docs=2)
    got = sections.split_sections(lines_of(spark, rows), 5).orderBy("doc_id", "section_no").collect()
    for doc in range(2):
        assert "\n".join(r.content for r in got if r.doc_id == doc) == "\n".join(r[4] for r in rows if r[0] == doc)


def test_blank_opening_is_dropped_only_before_a_header(spark):
    rows = [(1, "left", 0, 1, " ", False, 1.0), (1, "left", 1, 1, "1. Head", False, 1.0), (2, "left", 0, 1, " ", False, 1.0)]
    got = sections.split_sections(lines_of(spark, rows)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.name, r.content) for r in got] == [(1, "1. Head", "1. Head"), (2, "Full Document", "")]


def test_threshold_needs_twelve_sizes(spark):
    def limit(sizes):
        rows = [(1, "left", i, 1, "x", False, s) for i, s in enumerate(sizes)]
        return sections.font_thresholds(lines_of(spark, rows)).first().threshold

    assert limit([10.0] * 11 + [0.0]) == 0
    assert limit([10.0] * 6 + [12.0] * 6) == pytest.approx(13.2)


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_count_over_blocks(spark, inclusive):
    df = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("n"), (F.col("id") % 3 == 0).alias("f"))
    got = ordering.running_count(df, ["k"], "n", F.col("f"), "c", inclusive, total="t", block=4).orderBy("n").collect()
    assert [r.c for r in got] == [sum(i % 3 == 0 for i in range(n + inclusive)) for n in range(50)]
    assert {r.t for r in got} == {17}


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_ranks_of_one_large_group(spark, ranges):
    rng = random.Random(ranges)
    rows = [("g" if rng.random() < 0.9 else f"h{rng.randrange(3)}", rng.randrange(40), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, a int, b int").repartition(5)
    by = [F.col("a"), F.desc("b")]
    got = {(r.k, r.a, r.b): r.n for r in ordering.row_number_in_ranges(df, ["k"], by, "n", ranges).collect()}
    want, seen = {}, {}
    for k, a, b in sorted(rows, key=lambda r: (r[0], r[1], -r[2])):
        seen[k] = want[k, a, b] = seen.get(k, 0) + 1
    assert got == want
    blocks = ordering.in_ranges(df, ["k"], by, ranges).where("k = 'g'").groupBy("_block").count().collect()
    assert len(blocks) >= min(ranges, 2) and max(r["count"] for r in blocks) < 600 / ranges * 1.6


def test_sections_of_one_page_are_placed_in_several_ranges(spark):
    rows = [(1, "left", n, f"name {n % 50:03d}", None, [1], "x" * (n % 7 + 1) + str(n)) for n in range(400)]
    exact = dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION))
    got = {r.section_no: r.place for r in pairing.number_sections(exact).collect()}
    order = sorted(rows, key=lambda r: (r[3], -len(r[6]), r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}


def contained_by_loop(rows):
    """Sections that survive when each is compared with all larger or earlier ones."""
    norm = {r[2]: " ".join(r[6].split()).lower() for r in rows}
    kept = []
    for a in sorted(rows, key=lambda r: (-len(r[6]), r[2])):
        if not any(norm[a[2]] and norm[a[2]] in norm[b[2]] and set(a[5]) <= set(b[5]) for b in kept):
            kept.append(a)
    return {r[2] for r in kept}


@pytest.mark.parametrize("limits", [(), (50, 200), (1, 1), (300, 1 << 25), (1 << 20, 100)])
def test_containment_agrees_with_brute_force(spark, limits):
    rng = random.Random(sum(limits) + 3)
    words = ["the", "bank", "shall", "pay", "a", "fee", "т", "ok", "1", "11"]
    rows, texts = [], set()
    for n in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9, 25])))
        if rng.random() < 0.4 and texts:
            base = rng.choice(sorted(texts))
            i = rng.randrange(len(base))
            text = base[i : i + rng.randint(1, 30)].strip() or text
        if text in texts:
            continue
        texts.add(text)
        pages = sorted(rng.sample([1, 2, 3, 15, 16, 40], rng.choice([0, 1, 1, 2, 3])))
        rows.append((1, "left", n, "n", None, pages, text))
    exact = dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION))
    got = {r.section_no for r in dedupe.dedupe_contained(exact, *limits).collect()}
    want = contained_by_loop(rows)
    assert got == want and len(want) < len(rows)


def test_containment_of_odd_sections(spark):
    rows = [(1, "left", 0, "a", None, [1], "a b c"), (1, "left", 1, "b", None, None, "a b"), (1, "left", 2, "c", None, [], "b c"), (1, "left", 3, "d", None, [2], "a"),
            (2, "left", 4, "e", None, [1], "b"), (1, "right", 5, "f", None, [1], "c"), (1, "left", 6, "g", None, [1], " "), (1, "left", 7, "h", None, None, "q a b c q")]
    df = dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION))
    assert {r.section_no for r in dedupe.dedupe_contained(df).collect()} == {0, 1, 3, 4, 5, 6, 7}
    assert dedupe.dedupe_contained(df.limit(0)).collect() == []


def test_one_text_in_very_many_sections(spark):
    rows = [(1, "left", n, "n", None, [1], f"the same long phrase {n} ends") for n in range(1500)] + [(1, "left", 9000 + n, "n", None, [1], f"phrase {n} ends") for n in range(1500)]
    df = dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION))
    assert {r.section_no for r in dedupe.dedupe_contained(df, 5000, 20000).collect()} == set(range(1500))


def test_sections_meet_without_pages_only_where_one_has_none(spark, monkeypatch):
    """Sections of sides where all have pages go to their ranges alone."""
    passed = spark.sparkContext.accumulator(0)
    plain = dedupe._contained_in_stream

    def counted(batches):
        def look():
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        return plain(look())

    monkeypatch.setattr(dedupe, "_contained_in_stream", counted)
    rows = [(1, "left", i, "n", None, [i * 20], f"text {i}", i) for i in range(30)]
    rows += [(2, "left", 0, "n", None, [3, 40], "long text", 0), (2, "left", 1, "n", None, [], "text", 1), (2, "right", 0, "n", None, [1], "text", 0)]
    df = spark.createDataFrame(rows, SECTION + ", position bigint")
    assert [tuple(r) for r in dedupe.contained(df).collect()] == [(2, "left", 1)]
    assert passed.value == 30 + 2 + 2 + 1


def watched(spark, df, column):
    """The table, and how many of its rows were computed."""
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    return df.withColumn(column, F.udf(look, dict(df.dtypes)[column]).asNondeterministic()(column)), seen


def test_placed_sections_are_computed_once(spark):
    rows = [(1, "left", i, f"n{i % 7}", None, [1], f"text {i}", i) for i in range(40)]
    df, seen = watched(spark, spark.createDataFrame(rows, SECTION + ", position bigint"), "content")
    assert pairing.number_sections(df).count() == 40
    assert seen.value == 40


def test_written_records_are_computed_once(spark, tmp_path):
    rows = [("f", f"{i}.json", (f"s{i}", "text", ("n", [1], "ru", "h"))) for i in range(12)]
    schema = "folder string, file_name string, record struct<source_name: string, content: string, metadata: struct<section_name: string, page_numbers: array<int>, language: string, rag_header: string>>"
    df, seen = watched(spark, spark.createDataFrame(rows, schema), "file_name")
    write_section_files(df, str(tmp_path / "out"))
    assert read_section_files(spark, str(tmp_path / "out")).count() == 12
    assert seen.value == 12


def test_texts_of_whole_documents_are_dealt_twice(spark):
    lines = spark.createDataFrame([(d, s, 5000 * i, i, f"{d} {s} {i}") for d in (1, 2) for s in ("left", "right") for i in range(3)],
                                  "doc_id bigint, side string, line_no bigint, page int, text string")
    named = sections.whole_document(lines).join(spark.range(3).withColumnRenamed("id", "doc_id").hint("merge"), "doc_id")
    # By block, by document, and the names by document.
    assert named._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 3
    assert sorted(r.content for r in named.collect()) == [f"{d} {s} 0\n{d} {s} 1\n{d} {s} 2" for d in (1, 2) for s in ("left", "right")]


def test_files_are_listed_and_read_in_tasks(spark, tmp_path):
    names = ["a+b %20.json", "\"Мыйзам\" #1?.json", "_Закон_.json", *(f"{i}.json" for i in range(60))]
    rows = [(f, n, (f"s{n}", "текст\n" * i, ("n", [1, i], None, "h"))) for f in ("kyrgyz", "other") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "folder string, file_name string, record struct<source_name: string, content: string, metadata: struct<section_name: string, page_numbers: array<int>, language: string, rag_header: string>>")
    path = str(tmp_path / "out %41 +")
    write_section_files(df, path)
    (tmp_path / "out %41 +" / "_SUCCESS").touch()
    (tmp_path / "out %41 +" / ".spare-x").mkdir()
    (tmp_path / "out %41 +" / ".spare-x" / "half").write_text("{")
    for place in (path, path + "/", "file://" + path, "file:" + path):
        back = read_section_files(spark, place)
        assert back.inputFiles() == []  # the driver holds no list of files
        assert back.rdd.getNumPartitions() == 4
        assert sorted(back.collect()) == sorted(df.collect())


def test_exact_dedupe_keeps_the_first_and_is_stable(spark):
    rows = [(1, "left", 3, "c", None, [2], "Text  a"), (1, "left", 1, "a", None, [1], "text A"), (1, "right", 2, "b", None, [1], "text a"), (1, "left", 2, "x", None, [1], "İ"), (1, "left", 4, "e", None, [], "")]
    once = dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION))
    got = {(r.side, r.section_no, r.position) for r in once.collect()}
    assert got == {("left", 3, 1), ("right", 2, 2), ("left", 2, 2), ("left", 4, 4)}
    again = dedupe.dedupe_exact(once.drop("position"))
    assert {(r.side, r.section_no) for r in again.collect()} == {(s, n) for s, n, _ in got}


def section_rows(*triples, side="left", doc=1, start=0):
    return [(doc, side, start + i, name, key, [page], f"{name} {start + i}") for i, (name, key, page) in enumerate(triples)]


def pairs(spark, rows):
    df = dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION))
    got = pairing.pair_sections(df).orderBy("doc_id", "pair_order").collect()
    return [(r.pair_id, r.left and r.left.name, r.right and r.right.name) for r in got]


def test_pairing_by_key_orders_numbers_and_keeps_the_last(spark):
    left = section_rows(("ten", "10", 1), ("two", "2", 1), ("sub", "1.2", 1), ("loose", None, 1), ("two again", "2", 5))
    right = section_rows(("dva", "2", 1), ("long", "1.12345678901234567890123", 3), side="right", start=10)
    assert pairs(spark, left + right) == [
        ("1.2", "sub", None), ("1.12345678901234567890123", None, "long"), ("2", "two again", "dva"), ("10", "ten", None),
    ]
    lost = pairing.dropped_by_pairing(spark.createDataFrame(left + right, SECTION)).first()
    assert lost.dropped == 1


def test_pairing_by_place_without_keys(spark):
    left = section_rows(("b", None, 2), ("a", None, 1), ("c", None, 200))
    right = section_rows(("x", None, 1), side="right", start=10)
    assert pairs(spark, left + right) == [("1", "a", "x"), ("2", "b", None), ("3", "c", None)]


def test_output_order_sorts_keys_as_text(spark):
    rows = section_rows(("x", "2", 1), ("x", "10", 1))
    df = pairing.number_sections(dedupe.dedupe_exact(spark.createDataFrame(rows, SECTION)))
    assert [r.section_key for r in df.orderBy("place").collect()] == ["10", "2"]


def toc_of(spark, lines, count=50, page=1):
    rows = [(1, page, i, t) for i, t in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id bigint, toc_page int, line_no bigint, text string")
    counts = spark.createDataFrame([(1, count)], "doc_id bigint, page_count int")
    got = toc.toc_entries(df, counts, block=2).collect()
    return sorted((r.start_page, r.title) for r in got), df, counts


def test_toc_entries(spark):
    lines = [
        "СОДЕРЖАНИЕ", "1. Общие .... 3", "Очень длинное", "название раздела", "на три строки 7", "12", "–", "• Пункт 9", "1. общие .... 3",
        "Слишком далеко 99", "Ноль 0", "Содержаниее 4", "• 5", "хвост без номера",
    ]
    got, _, _ = toc_of(spark, lines)
    assert got == [(3, "1. Общие ...."), (4, "Содержаниее"), (7, "Очень длинное название раздела на три строки"), (9, "Пункт")]


@pytest.mark.parametrize("block", [1, 2, 7, 4096])
def test_entries_wrapped_over_blocks_match_the_plain_loop(spark, block):
    rng = random.Random(block)
    rows = [(d, p, n * 3, rng.choice(["Глава", "о земле", "раздел 4", "Пункт .... 9", "12", "СОДЕРЖАНИЕ", " часть  2 ", "b 77"]))
            for d in range(3) for p in (1, 2) for n in range(rng.randint(0, 25))]
    want = {}
    for d in range(3):
        for p in (1, 2):
            waiting = []
            for line in (" ".join(t.split()) for doc, page, _, t in rows if (doc, page) == (d, p)):
                if line in ("12", "СОДЕРЖАНИЕ"):
                    continue
                waiting.append(line)
                if re.search(r"[^ ] \d+$", line):
                    title, number = " ".join(waiting).rsplit(" ", 1)
                    waiting = []
                    if int(number) <= 50:
                        want.setdefault((d, title.lower(), int(number)), title)
    df = spark.createDataFrame(rows, "doc_id bigint, toc_page int, line_no bigint, text string")
    counts = spark.createDataFrame([(d, 50) for d in range(3)], "doc_id bigint, page_count int")
    got = toc.toc_entries(df, counts, block=block).collect()
    assert sorted((r.doc_id, r.title, r.start_page) for r in got) == sorted((d, t, n) for (d, _, n), t in want.items())


def test_contents_are_read_once(spark):
    """Sections by contents take every raw line once, however many steps need the entries."""
    seen = spark.sparkContext.accumulator(0)

    def look(t):
        seen.add(1)
        return t

    _, toc_lines, counts = toc_of(spark, ["Aa 3", "Bb 4", "Cc", "Dd 6"], count=9)
    seen_lines = toc_lines.withColumn("text", F.udf(look, "string").asNondeterministic()("text"))
    lines = lines_of(spark, [(1, "left", i, i, f"line {i}", False, 1.0) for i in range(1, 9)])
    got = pdf_corpus.toc_sections(lines, seen_lines, counts).collect()
    assert sorted(r.name for r in got) == ["Aa", "Bb", "Cc Dd"]
    assert seen.value == 4


def test_toc_last_entry_of_a_page_wins_and_early_lines_are_dropped(spark):
    _, toc_lines, counts = toc_of(spark, ["A 3", "B 3", "C 5", "D 8"], count=9)
    rows = [(1, "full", p * 10 + i, p, f"p{p} {i}", False, 1.0) for p in range(1, 8) for i in range(2)]
    intervals = toc.toc_intervals(toc.toc_entries(toc_lines, counts), counts)
    assert sorted(tuple(r) for r in intervals.collect()) == [(1, "B", 3, 4), (1, "C", 5, 7), (1, "D", 8, 9)]
    got = {r.name: r for r in toc.sections_from_toc(lines_of(spark, rows), intervals, block=3).collect()}
    assert got["B"].content.splitlines() == ["p3 0", "p3 1", "p4 0", "p4 1"] and got["B"].page_numbers == [3, 4]
    assert got["C"].page_numbers == [5, 6, 7]
    assert got["D"].content == "" and got["D"].page_numbers == []


def test_toc_page_must_exist(spark):
    pages = spark.createDataFrame([(1, 3)], "doc_id bigint, toc_page int")
    counts = spark.createDataFrame([(1, 2)], "doc_id bigint, page_count int")
    with pytest.raises(Exception, match="out of range"):
        toc.check_toc_pages(pages, counts).collect()


def test_page_range(spark):
    def ask(a, b, total):
        cols = [F.lit(x).cast("int") for x in (a, b, total)]
        return tuple(spark.range(1).select(layout.page_range(*cols).alias("r")).select("r.*").first())

    assert ask(None, None, 9) == (1, 9)
    assert ask(-3, 99, 9) == (1, 9)
    assert ask(2, 4, 9) == (2, 4)
    assert ask(5, 1, 0) == (1, 0)
    with pytest.raises(Exception, match="invalid page range"):
        ask(5, 4, 9)
    with pytest.raises(Exception, match="not a PDF"):
        spark.range(1).select(layout.checked_pdf_path(F.lit("a.txt"))).collect()


def test_names_are_unique_and_fit(spark):
    long = "ы" * 160
    names = ["Intro", "intro", "INTRO", long, long, long.upper(), "intro__2"]
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(names)], "doc_id bigint, position bigint, n string")
    got = [r.file_name for r in naming.unique_names(df, F.col("n"), "position").orderBy("position").collect()]
    assert got[:3] == ["Intro", "intro__2", "INTRO__3"]
    assert got[3:6] == [long, "ы" * 157 + "__2", "Ы" * 157 + "__3"]
    assert len({n.lower() for n in got}) == len(got) and max(map(len, got)) == 160


def first_free(bases):
    """The plain loop: each row takes the first free name."""
    used, names = set(), []
    for base in bases:
        name, k = base, 2
        while name.lower() in used:
            suffix = f"__{k}"
            name, k = base[: 160 - len(suffix)] + suffix, k + 1
        used.add(name.lower())
        names.append(name)
    return names


def test_names_that_clash_once_suffixed_match_the_plain_loop(spark):
    rng = random.Random(9)
    long = "y" * 156
    parts = ["intro", "Intro__2", "intro__2__2", "intro__3", "INTRO__2__2", "other", "other__02", long, long + "__2", long[:-2] + "__10", long + "zzzz", "__2"]
    cases = [["intro", "intro", "intro__2", "intro__2"], ["intro__2", "intro", "intro", "intro"], [long + "abcd"] * 12 + [long + "abce"] * 12]
    cases += [[rng.choice(parts) for _ in range(rng.randint(1, 40))] for _ in range(30)]
    rows = [(d, i, n) for d, names in enumerate(cases) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id bigint, position bigint, n string").repartition(3)
    got = {}
    for r in naming.unique_names(df, F.col("n"), "position").orderBy("doc_id", "position").collect():
        got.setdefault(r.doc_id, []).append(r.file_name)
    assert [got[d] for d in range(len(cases))] == [first_free(names) for names in cases]


def test_families_of_a_third_of_all_rows_match_the_plain_loop(spark):
    rng = random.Random(12)
    hot = ["Part"] * 900 + [f"part__{k}" for k in range(2, 120)] + ["PART__5__2", "part__01", "part__1", "part__99999999999999999999"]
    cut = ["z" * 156 + rng.choice("abcd") + "tail"[: rng.randint(0, 3)] for _ in range(300)] + ["z" * 156 + "__30", "z" * 157 + "__4"]
    late = ["Part"] * 50 + [f"part__{k}" for k in range(2, 40)]
    early = late[::-1]
    cases = [rng.sample(hot, len(hot)), rng.sample(cut, len(cut)), late, early]
    rows = [(d, 7 * i, n) for d, names in enumerate(cases) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id bigint, position bigint, n string").repartition(3)
    got = {}
    for r in naming.unique_names(df, F.col("n"), "position").orderBy("doc_id", "position").collect():
        got.setdefault(r.doc_id, []).append(r.file_name)
    assert [got[d] for d in range(len(cases))] == [first_free(names) for names in cases]


def test_stems_of_sources_named_by_strings(spark):
    stems = ["report"] * 40 + ["Report", "other", "report__3"]
    rows = [(f"id {i}", "s", n) for i, n in enumerate(stems)]
    df = spark.createDataFrame(rows, "doc_id string, source_name string, stem string")
    placed = [r.stem for r in df.orderBy(F.xxhash64("doc_id")).collect()]
    got = naming.unique_stems(df)
    assert got.columns == df.columns
    assert [r.stem for r in got.orderBy(F.xxhash64("doc_id")).collect()] == first_free(placed)


def test_no_python_where_names_clash(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "A"), (1, 3, "a__2")], "doc_id bigint, position bigint, n string")
    plan = naming.unique_names(df, F.col("n"), "position")._jdf.queryExecution().toString()
    assert "InPandas" not in plan and "ArrowEval" not in plan


def test_equal_stems_of_one_run_get_different_files(spark):
    rows = [(d, "left", 0, 1, f"text {d}", False, 1.0) for d in (1, 2, 3)]
    names = spark.createDataFrame([(1, "a.pdf", "a"), (2, "b/A.pdf", "A"), (3, "a__2.pdf", "a__2")], "doc_id bigint, source_name string, stem string")
    for got in (pdf_corpus.full_files(lines_of(spark, rows), names), pdf_corpus.bilingual_files(lines_of(spark, rows), names)):
        paths = [(r.folder, r.file_name.lower()) for r in got.collect()]
        assert len(set(paths)) == len(paths) >= 3


def test_a_side_without_lines_gives_an_empty_section(spark):
    rows = [(1, "left", i, 1, t, False, 10.0) for i, t in enumerate(["plain text", "more"])]
    got = pdf_corpus.bilingual_files(lines_of(spark, rows), sources(spark)).collect()
    assert {(r.side, r.file_name, r.record.content, tuple(r.record.metadata.page_numbers)) for r in got} == {
        ("left", "Закон 1__1__ky__Full Document.json", "plain text\nmore", (1,)), ("right", "Закон 1__1__ru__Full Document.json", "", ()),
    }
    one = pdf_corpus.bilingual_files(lines_of(spark, rows), sources(spark), take="right").collect()
    assert [(r.side, r.record.content) for r in one] == [("right", "")]
    keyed = [(1, "left", i, 1, t, False, 10.0) for i, t in enumerate(["1. Жалпы жоболор", "тексттер"])]
    assert [r.side for r in pdf_corpus.bilingual_files(lines_of(spark, keyed), sources(spark)).collect()] == ["left"]


def test_documents_without_entries_are_reported(spark):
    rows = [(d, "left", i, p, f"line {p}", False, 10.0) for d in (1, 2) for i, p in enumerate((1, 2))]
    two = spark.createDataFrame([(1, "a.pdf", "a"), (2, "b.pdf", "b")], "doc_id bigint, source_name string, stem string")
    toc = spark.createDataFrame([(1, 1, 0, "Title one .... 1"), (2, 1, 0, "no page here")], "doc_id bigint, toc_page int, line_no bigint, text string")
    counts = spark.createDataFrame([(1, 2), (2, 2)], "doc_id bigint, page_count int")
    assert [r.doc_id for r in pdf_corpus.without_entries(toc, counts, two).collect()] == [2]
    assert {r.doc_id for r in pdf_corpus.toc_files(lines_of(spark, rows), toc, counts, two).collect()} == {1}
    with pytest.raises(ValueError, match="document 2"):
        pdf_corpus.toc_files(lines_of(spark, rows), toc, counts, two, strict=True)
    both = rows + [(1, "right", 9, 1, "right line", False, 10.0)]
    taken = pdf_corpus.toc_files(lines_of(spark, both), toc, counts, two, bilingual=True, take="right").collect()
    assert [(r.side, r.record.content) for r in taken] == [("right", "right line")]


def test_majority_language_tie_goes_by_name(spark):
    rows = [(1, "left", i, "n", None, [1], t) for i, t in enumerate(["hello", "привет"])]
    assert tuple(naming.majority_language(spark.createDataFrame(rows, SECTION)).first()) == (1, "en", "english")


def sources(spark):
    return spark.createDataFrame([(1, "Закон 1.pdf", "Закон 1")], "doc_id bigint, source_name string, stem string")


def test_bilingual_files(spark):
    rows = []
    for side, words in (("left", ["1. Жалпы жоболор", "тексттер", "2. Аяктоо"]), ("right", ["1. Общие положения", "тексты"])):
        rows += [(1, side, i, 1, w, False, 10.0) for i, w in enumerate(words)]
    got = pdf_corpus.bilingual_files(lines_of(spark, rows), sources(spark)).collect()
    assert {(r.folder, r.file_name) for r in got} == {
        ("kyrgyz", "Закон 1__1__ky__1. Жалпы жоболор.json"), ("kyrgyz", "Закон 1__2__ky__2. Аяктоо.json"),
        ("russian", "Закон 1__1__ru__1. Общие положения.json"),
    }
    record = next(r.record for r in got if r.folder == "russian")
    assert record.metadata.rag_header == "[Document: Закон 1.pdf]\n[Section: 1. Общие положения]"
    assert record.content == "1. Общие положения\nтексты" and record.metadata.page_numbers == [1]


def test_unsplit_sides_without_lines_give_empty_files(spark):
    rows = [(1, "left", 0, 1, "x", False, 1.0)]
    got = pdf_corpus.bilingual_files(lines_of(spark, rows), sources(spark), split=False).collect()
    assert {(r.file_name, r.record.content) for r in got} == {("Закон 1__ky.json", "x"), ("Закон 1__ru.json", "")}


def test_record_json_writes_nulls(spark):
    row = spark.range(1).select(naming.record_json(F.struct(F.lit(None).cast("string").alias("a"), F.lit("ү").alias("b"))))
    assert row.first()[0] == '{"a":null,"b":"ү"}'
