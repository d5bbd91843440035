import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

rng = random.Random(6)
WORDS = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture
def folder(spark, save):
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = prose(60).upper().replace(" ", "!! ") if bad else "\n".join(prose(20) for _ in range(3))
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    rows += [(1000, rows[1][1]), (1001, rows[2][1].replace(" ", "  ", 3)), (1002, prose(30)), (1003, None), (1004, "")]
    item = prose(30)
    rows += [(1005, prose(40) + "\n" + item), (1006, prose(20) + " " + item.replace(" ", ", ", 4).upper() + " " + prose(9))]
    shared = prose(55)
    rows += [(2000 + i, prose(30) + "\n" + shared) for i in range(5)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return save(
        documents=docs, labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, item), (2, prose(25))], "item_id bigint, text string"),
    ), dict(rows), shared


def test_each_stage_takes_effect_on_its_own_input(spark, folder):
    sf_dir, rows, shared = folder
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS and docs.dtypes == before.dtypes
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name.split(" ")[0]] = {r["doc_id"]: r for r in docs.collect()}
    good = {d for d in rows if d >= 1000 or d % 5}
    texts = {d for d in good if rows[d]}
    assert texts - seen["quality"].keys() == set() and len(seen["quality"].keys() - good) < 6
    lines = seen["line"]
    assert lines.keys() == seen["quality"].keys()
    assert shared in lines[2000]["text"] and not any(shared in lines[2000 + i]["text"] for i in range(1, 5))
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values()) and lines[1000]["text"] == ""
    assert lines.keys() >= seen["MinHash"].keys() >= texts - {1000, 1001}
    assert seen["MinHash"].keys() - seen["benchmark"].keys() == {1005, 1006}
    last = seen["SentencePiece"]
    assert last.keys() == seen["benchmark"].keys() and all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in last.values())


def test_near_copies_are_dropped(spark, folder):
    sf_dir, rows, _ = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, sf_dir).collect()}
    assert kept == rows.keys() - {1000, 1001}


def test_run_is_the_stages_in_order(spark, folder):
    sf_dir, _, _ = folder
    out = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    assert digest(out) == digest(docs)


def test_empty_tables(spark, save):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    sf_dir = save(documents=docs, labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), benchmark=spark.createDataFrame([], "item_id bigint, text string"))
    assert corpus_pipeline.run(spark, sf_dir).collect() == []
