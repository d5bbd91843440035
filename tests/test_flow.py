import json
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from korpusmill.catalog import documents, inputs
from korpusmill.operators import layout
from korpusmill.operators.crawl import discover
from korpusmill.plans.web_corpus import collect_site
from korpusmill.profiles import EN, KG, RU
from korpusmill.session import shared_folder
from korpusmill.sinks.files import read_section_files, write_jsonl, write_section_files
from korpusmill.sources import pdf
from korpusmill.streaming.web_stream import first_by_ordinal, read_pages, read_saved, save_batches, save_stream, stream_documents

SF = "/root/testdata/sf0.001"
PAGE = "page_id bigint, url string, html string"


def site(spark, graph):
    rows = [(i, u, "".join(f'<a href="{x}">x</a>' for x in links)) for i, (u, links) in enumerate(graph.items())]
    return spark.createDataFrame(rows, PAGE)


GRAPH = {
    "https://h.example.org/kg/": ["a", "/kg/b/", "/ru/out", "https://o.example.org/kg/x", "doc.pdf"],
    "https://h.example.org/kg/a": ["/kg", "b", "deep/1"],
    "https://h.example.org/kg/deep/1": ["2", "missing"],
    "https://h.example.org/kg/deep/2": ["1", "../a"],
}


def found(spark, graph, root, profile, **more):
    seeds = spark.createDataFrame([(root,)], "root_url string")
    return sorted((r.level, r.url.removeprefix("https://h.example.org")) for r in discover(site(spark, graph), seeds, profile, **more).collect())


def test_crawl_follows_links_in_scope(spark):
    got = found(spark, GRAPH, "https://H.example.org/kg/", KG)
    assert got == [(0, "/kg"), (1, "/kg/a"), (1, "/kg/b"), (2, "/kg/deep/1"), (3, "/kg/deep/2"), (3, "/kg/deep/missing")]


def test_crawl_counting_fetched_pages_leaves_out_missing_ones(spark):
    got = found(spark, GRAPH, "https://h.example.org/kg/", EN)
    assert got == [(0, "/kg"), (1, "/kg/a"), (2, "/kg/deep/1"), (3, "/kg/deep/2")]
    assert found(spark, GRAPH, "https://h.example.org/kg/", EN, max_pages=3) == got[:3]
    assert found(spark, GRAPH, "https://h.example.org/kg/", KG, max_pages=2) == [(0, "/kg"), (1, "/kg/a")]


def test_a_deep_crawl(spark):
    chain = {f"https://h.example.org/kg/{i}": [f"/kg/{i + 1}", f"/kg/{i // 2}", "/kg/hub"] for i in range(8)}
    got = found(spark, chain, "https://h.example.org/kg/0", RU, strict_parity=True)
    assert got == [] or len({u for _, u in got}) == len(got)
    wide = found(spark, {"https://h.example.org/kg/": ["0"], **chain}, "https://h.example.org/kg/", RU)
    assert [u for _, u in wide if u.rsplit("/", 1)[1].isdigit()] == [f"/kg/{i}" for i in range(9)]
    assert [level for level, u in wide if u.endswith("hub")] == [2]


def test_crawl_of_an_unknown_root(spark):
    assert found(spark, GRAPH, "https://h.example.org/nowhere", RU) == [(0, "/nowhere")]
    assert found(spark, GRAPH, "https://h.example.org/nowhere", EN) == []
    assert found(spark, GRAPH, "https://h.example.org/file.pdf", RU) == []


def test_crawl_does_not_depend_on_partitioning(spark):
    pages, seeds = site(spark, GRAPH), spark.createDataFrame([("https://h.example.org/kg",)], "root_url string")
    results = {tuple(sorted(map(tuple, discover(pages.repartition(n), seeds, KG).collect()))) for n in (1, 7)}
    assert len(results) == 1


def test_aliased_root_covers_its_children(spark):
    graph = {"https://h.example.org/kg/chastnym-klientam/": ["/kg/x", "/kg/chastnym-klientam/y"]}
    assert len(found(spark, graph, "https://h.example.org/kg/chastnym-klientam/", KG)) == 3
    assert len(found(spark, graph, "https://h.example.org/kg/chastnym-klientam/", KG, strict_parity=True)) == 1


def test_collect_site(spark):
    docs = collect_site(site(spark, GRAPH), "https://h.example.org/kg/", EN, "en").orderBy("ordinal").collect()
    assert [d.source_url for d in docs] == ["https://h.example.org/kg", "https://h.example.org/kg/a", "https://h.example.org/kg/deep/1", "https://h.example.org/kg/deep/2"]
    assert {d.category for d in docs} == {"kg"} and docs[2].subcategory_path == ["deep", "1"]
    assert {d.root_category_url for d in docs} == {"https://h.example.org/kg"}


def test_collect_site_reads_no_links_elsewhere(spark):
    graph = GRAPH | {"https://other.example.org/kg/a": [], "https://h.example.org/elsewhere": []}
    read = F.when(F.col("url").rlike("//other|/elsewhere"), F.raise_error(F.lit("read"))).otherwise(F.col("html"))
    docs = collect_site(site(spark, graph).withColumn("html", read), "https://h.example.org/kg/", RU)
    assert {d.source_url for d in docs.collect()} >= {"https://h.example.org/kg", "https://h.example.org/kg/a"}


def test_pdf_spans_to_lines(spark, tmp_path):
    def fake_reader(content, page_from, page_to):
        for page in range(page_from, (page_to or 3) + 1):
            for line, text in enumerate(content.decode().split("|")):
                for side, x in (("L", 10.0), ("R", 320.0)):
                    yield {
                        "page": page, "page_count": 3, "block_type": 0, "block_no": 0, "line_in_block": line * 2 + (side == "R"),
                        "span_no": 0, "text": f" {text}{side}{page} ", "size": 10.0, "flags": 16, "font": "A", "x0": x, "x1": x + 50,
                        "line_x0": x, "line_y0": 100.0 - line, "page_x0": 0.0, "page_x1": 600.0,
                    }

    (tmp_path / "Doc.PDF").write_bytes(b"one|two")
    files = pdf.pdf_files(spark, str(tmp_path))
    spans = pdf.read_spans(files, fake_reader, 2, 3, rows_per_batch=3)
    assert spans.count() == 8
    left = layout.lines_from_spans(spans, "left").orderBy("line_no").collect()
    assert [(r.page, r.text, r.is_bold) for r in left] == [(2, "oneL2", True), (2, "twoL2", True), (3, "oneL3", True), (3, "twoL3", True)]
    ordered = layout.lines_from_spans(spans, None, by_position=True).orderBy("line_no").collect()
    assert [r.text for r in ordered][:4] == ["twoL2", "twoR2", "oneL2", "oneR2"]
    names = pdf.document_names(files).first()
    assert (names.source_name, names.stem) == ("Doc.PDF", "Doc")
    toc_pages = names.doc_id, 3
    lines = pdf.toc_page_lines(spans, spark.createDataFrame([toc_pages], "doc_id string, toc_page int"))
    assert [r.text for r in lines.orderBy("line_no").collect()] == [" oneL3 ", " oneR3 ", " twoL3 ", " twoR3 "]


def test_section_files_and_json_lines(spark, tmp_path):
    plan = documents.pdf_corpus.full_files(inputs.document_lines(spark, SF).where("side = 'left'"), documents._sources(spark, SF))
    write_section_files(plan, str(tmp_path / "out"))
    written = list((tmp_path / "out").glob("*/*.json"))
    assert len(written) == plan.count()
    one = json.loads(written[0].read_text(encoding="utf-8"))
    assert list(one) == ["source_name", "content", "metadata"]
    assert written[0].read_text(encoding="utf-8").startswith('{\n  "source_name": "Мыйзам')
    assert not list((tmp_path / "out").glob(".spare*"))
    back = read_section_files(spark, str(tmp_path / "out"))
    order = ["folder", "file_name"]
    assert back.orderBy(*order).collect() == plan.select("folder", "file_name", "record").orderBy(*order).collect()
    with pytest.raises(ValueError, match="2 records for"):
        write_section_files(plan.unionByName(plan), str(tmp_path / "twice"))
    assert not (tmp_path / "twice").exists()
    docs = spark.createDataFrame([("ү", None, "kyrgyz")], "a string, b string, folder string")
    write_jsonl(docs, str(tmp_path / "lines"), ("folder",))
    part = next((tmp_path / "lines" / "folder=kyrgyz").glob("part-*.json"))
    assert part.read_text(encoding="utf-8") == '{"a":"ү","b":null}\n'


def test_stream_keeps_one_document_per_url(spark, tmp_path):
    source, out, place = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in range(2):
        rows = [(i, f"https://h.example.org/p{i % 3}/?v={batch}", f"<p>text of page number {i % 3}</p>") for i in range(6)]
        spark.createDataFrame(rows, PAGE).coalesce(1).write.mode("append").parquet(source)
        docs = stream_documents(read_pages(spark, source), F.lit("https://h.example.org/"), F.lit("c"), F.lit("ru"), RU)
        save_stream(docs, out, place).awaitTermination()
    got = spark.read.json(out).collect()
    assert sorted(r.source_url for r in got) == [f"https://h.example.org/p{i}" for i in range(3)]
    assert {r.content_text for r in got} == {f"text of page number {i}" for i in range(3)}


def test_stream_forgets_urls_beyond_the_horizon(spark, tmp_path):
    source, out, place = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = PAGE + ", at timestamp"
    for day in ("2024-01-01", "2024-01-02", "2024-06-01", "2024-06-02", "2024-12-01"):
        row = (1, "https://h.example.org/p", "<p>text of the page</p>", day)
        one = spark.createDataFrame([row], PAGE + ", at string").withColumn("at", F.to_timestamp("at"))
        one.coalesce(1).write.mode("append").parquet(source)
        docs = stream_documents(
            read_pages(spark, source, schema), F.lit("https://h.example.org/"), F.lit("c"), F.lit("ru"), RU, seen_at="at"
        )
        save_stream(docs, out, place).awaitTermination()
    assert 2 <= spark.read.json(out).count() < 5


VISIT = "ordinal bigint, url string, note string"
VISITS = [(i, f"u{i % 4}" if i % 7 else None, f"n{i}") for i in range(60, 0, -1)] + [(None, "u0", "none"), (None, "only", "last")]


@pytest.mark.parametrize("salts", [1, 3])
def test_first_of_a_stream_goes_by_ordinal(spark, tmp_path, salts):
    source, out, place = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], VISIT).schema
    batch = spark.createDataFrame(VISITS, VISIT)
    want = {r.url: (r.ordinal, r.note) for r in sorted(batch.collect(), key=lambda r: -(r.ordinal or 99))}
    spark.createDataFrame([], VISIT).write.parquet(source)
    for at in range(0, len(VISITS), 31):
        spark.createDataFrame(VISITS[at : at + 31], VISIT).coalesce(1).write.mode("append").parquet(source)
        stream = first_by_ordinal(spark.readStream.schema(schema).parquet(source), salts=salts)
        save_batches(stream, out, place).awaitTermination()
        if at == 0:
            early = {r.url: r.ordinal for r in read_saved(spark, out, schema).collect()}
    got = read_saved(spark, out, schema)
    assert {r.url: (r.ordinal, r.note) for r in got.collect()} == want and got.count() == len(want)
    assert early["u1"] > want["u1"][0]
    save_batches(first_by_ordinal(spark.readStream.schema(schema).parquet(source), salts=salts), out, str(tmp_path / "anew")).awaitTermination()
    assert sorted(map(repr, read_saved(spark, out, schema).collect())) == sorted(map(repr, got.collect()))  # batches run again double nothing


def test_first_of_a_stream_forgets_by_timer(spark, tmp_path):
    source, out, place = (str(tmp_path / n) for n in ("in", "out", "state"))
    ddl = "ordinal bigint, url string, at timestamp"
    schema = spark.createDataFrame([], ddl).schema
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-06-01", "2024-06-02", "2024-12-01")):
        rows = [(10 + i, "u" if i in (0, 1, 4) else "v", day), (i, f"other{i}", day)]
        spark.createDataFrame(rows, "ordinal bigint, url string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(source)
        stream = first_by_ordinal(spark.readStream.schema(schema).parquet(source), seen_at="at", salts=1)
        save_batches(stream, out, place).awaitTermination()
    given = sorted(r.ordinal for r in spark.read.schema(schema).parquet(out).where("url = 'u'").collect())
    assert given == [10, 14]  # a day later it is still known, eleven months later it is not
    assert {r.ordinal for r in read_saved(spark, out, schema).where("url = 'u'").collect()} == {10}


QUICK = (
    "stream_keep_first",
    "normalize_multiline", "trim_footer_noise", "detect_language", "canonical_urls", "join_urls", "page_documents", "url_keep_last",
    "header_sections", "toc_entries", "collision_names",
)


@pytest.mark.parametrize("name", QUICK)
def test_registered_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations", "events", "orders", "customer", "lineitem"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registry.queries()[name](spark, SF)
    result = db.execute(registry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want


def test_registry(spark):
    assert set(registry.oracle_sql()) <= set(registry.queries())
    start = time.time()
    assert registry.entry(spark).count() > 0
    assert time.time() - start < 120


class Unset:
    """A session without a shared folder."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master = self, self, master

    def get(self, key, default):
        return default


def test_only_a_local_session_may_lack_a_shared_folder():
    assert shared_folder(Unset("local[2]"), "x") != shared_folder(Unset("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Unset("spark://host"), "x")
