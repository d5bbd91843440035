import itertools
import random
import zlib

import numpy as np
import pytest

from korpusmill.llm import quality

rng = random.Random(8)
WORDS = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(500)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def junk(n):
    kind = rng.randrange(3)
    return prose(n).upper().replace(" ", "!! ") if kind == 0 else " | ".join(prose(n).split()) if kind == 1 else (rng.choice(WORDS) + " ") * n


ROWS = [(i, junk(rng.randint(5, 80)) if i % 4 == 0 else prose(rng.randint(5, 80))) for i in range(900)]


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


def test_sum_of_squares_identity():
    r = np.random.default_rng(0)
    m = quality.Machine(0.3, r.normal(size=quality.BUCKETS).astype(np.float32), r.normal(size=(quality.BUCKETS, quality.FACTORS)).astype(np.float32))
    ids, xs = r.integers(0, quality.BUCKETS, 12).astype(np.int32), r.normal(size=12).astype(np.float32)
    raw, _ = m.raw(ids, xs, np.array([0, 5]))
    for part, got in ((slice(0, 5), raw[0]), (slice(5, 12), raw[1])):
        i, x = ids[part], xs[part]
        pairs = sum(float(m.factors[i[a]] @ m.factors[i[b]]) * x[a] * x[b] for a, b in itertools.combinations(range(len(i)), 2))
        assert got == pytest.approx(m.bias + float(m.weights[i] @ x) + pairs, rel=1e-3)


def test_held_out_accuracy_and_clean_documents(spark, documents):
    rows = ROWS + [(2000, None), (2001, ""), (None, prose(30)), (3, ROWS[3][1]), (2002, prose(60_000))]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i, _ in ROWS] + [(None, 1, 0), (5, None, 0), (7, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = quality.score_quality(docs, quality.train(docs, labels))
    assert sorted(out.columns) == sorted(docs.columns) and out.columns[-1] == "score"
    scored = out.select("doc_id", "score", quality.held_out(out["doc_id"]).alias("out")).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    tested = [r for r in scored if r["out"] and r["doc_id"] < 900]
    assert len(tested) > 100 and all(held(r["doc_id"]) for r in tested)
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in tested]) > 0.95
    kept = quality.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    clean = [i for i, _ in ROWS if i % 4]
    assert len(set(clean) & set(ids)) > 0.98 * len(clean) and len([i for i in ids if i is not None and i < 900 and i % 4 == 0]) < 25


def test_training_rows_are_bounded_and_never_held_out(spark, documents):
    labels = spark.createDataFrame([(i, int(not held(i))) for i, _ in ROWS], "doc_id bigint, quality int")
    rows = quality.training_rows(documents(ROWS + ROWS[:300]), labels, max_rows=50).collect()
    assert len(rows) == 50 and all(r["label"] == 1 and not held(r["key"]) and r["text"] == dict(ROWS)[r["key"]] for r in rows)


def test_without_rows_or_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    machine = quality.train(documents([]), none)
    assert quality.score_quality(documents([]), machine).collect() == []
    assert quality.score_quality(documents([(1, None)]), machine).first()["score"] == pytest.approx(0.5, abs=0.1)
    ones = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id bigint, quality int")
    machine = quality.train(documents(ROWS[:60]), ones)
    assert min(r["score"] for r in quality.score_quality(documents(ROWS[:60]), machine).collect()) > 0.5


def test_an_identical_rerun_gives_identical_scores(spark, documents):
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i, _ in ROWS[:200]], "doc_id bigint, quality int")
    a, b = (quality.train(documents(ROWS[:200]).repartition(n), labels) for n in (1, 3))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_twenty_thousand_labelled_rows_take_part(spark):
    docs = spark.range(26_000).selectExpr("id AS doc_id", "CAST(id AS string) AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality")
    assert quality.training_rows(docs, labels).count() == 20_000
