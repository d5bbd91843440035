import numpy as np
import pytest

from korpusmill.llm import whitening
from korpusmill.llm.whitening import leading_pairs, whiten

gen = np.random.default_rng(3)


def table(spark, rows, kind="float"):
    wide = [(i, v, 1, 0.5, "x") for i, v in rows]
    return spark.createDataFrame(wide, f"vec_id bigint, embedding array<{kind}>, n bigint, deviation double, label string")


def expected(vectors, components):
    """Whole numbers, deviations, whitened values and shares by numpy's dense solver."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    deviations = [sum(int(v) ** 2 for v in row) for row in n * x - s]
    return n, deviations, (n * x - s) / n @ turn / np.sqrt(values), values / (np.square(centred).sum() / n)


def compare(rows, vectors, components):
    n, deviations, white, share = expected(vectors, components)
    k = white.shape[1]
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-8
    assert [r["component"] for r in rows] == list(range(1, k + 1)) * (len(rows) // k)
    assert [r["deviation"] for r in rows[::k]] == deviations and {r["n"] for r in rows} == {n}
    assert np.allclose([r["explained"] for r in rows[:k]], share, rtol=1e-10)
    assert max(r["identity_error"] for r in rows) < 1e-9


@pytest.mark.parametrize("dim, size, components", [(64, 300, 16), (200, 500, 16), (5, 60, 16), (1, 9, 3), (40, 90, 4)])
def test_matches_a_dense_solver(spark, dim, size, components):
    vectors = np.float32(gen.standard_normal((size, dim)) * np.linspace(1, 2, dim))
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    compare(whiten(df, components=components).orderBy("vec_id", "component").collect(), vectors, min(dim, components))


def test_copies_count_once(spark):
    vectors = [v.tolist() for v in np.float32(gen.standard_normal((50, 6)))]
    vectors = vectors + [vectors[3]] * 70
    df = table(spark, list(enumerate(vectors))).repartition(5)
    rows = whiten(df).orderBy("vec_id", "component").collect()
    assert len(rows) == 120 * 6 and rows[0]["n"] == 50
    compare(rows, vectors, 6)


def test_unsound_rows(spark):
    good = [(i, v.tolist()) for i, v in enumerate(gen.standard_normal((30, 4)))]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 2.0, 3.0]), (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1e30, 0.0, 0.0, 0.0]), (106, [1.0, 2.0])]
    rows = whiten(table(spark, good + bad, "double")).orderBy("vec_id", "component").collect()
    assert {r["vec_id"] for r in rows} == set(range(30))
    compare(rows, [v for _, v in good], 4)
    same_id = whiten(table(spark, [(None, v) for _, v in good] + [(1, good[0][1])], "double")).collect()
    assert len(same_id) == 31 * 4


def test_tables_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(20)]):
        found = whiten(table(spark, rows))
        assert found.collect() == [] and found.dtypes == [tuple(f.split(" ")) for f in whitening._WHITE.split(", ")]


def test_flat_directions_are_left_out(spark):
    vectors = [[float(a), float(b), 0.25, float(a + b)] for a in range(8) for b in range(5)]
    rows = whiten(table(spark, list(enumerate(vectors)))).orderBy("vec_id", "component").collect()
    assert len(rows) == 40 * 2
    compare(rows, vectors, 2)


def test_deviations_beyond_64_bits():
    x, sums = np.array([[1 << 40, 0], [3, 4]]), np.zeros(2, np.int64)
    assert whitening._deviations(x, 1, sums) == [None, 25]
    assert whitening._deviations(np.array([[2 << 30, 1]]), 1, sums) == [(2 << 30) ** 2 + 1]


def test_partial_sums_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_SUMS", 2)
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 64)
    vectors = gen.standard_normal((200, 7))
    compare(whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], "double").repartition(9)).orderBy("vec_id", "component").collect(), vectors, 7)


def test_filter_works_with_passes_alone():
    values = np.concatenate([np.linspace(30, 20, 16), np.linspace(18, 1, 284)])
    basis = np.linalg.qr(gen.standard_normal((300, 300)))[0]
    found = leading_pairs(lambda q: basis @ (values[:, None] * (basis.T @ q)), 300, values.sum(), 16)
    assert np.allclose(found.values, values[:16], rtol=1e-12) and found.passes < 120
    assert np.abs(np.abs((basis[:, :16] * found.vectors).sum(axis=0)) - 1).max() < 1e-10


def test_uncertified_pairs_are_an_error(monkeypatch):
    monkeypatch.setattr(whitening, "MAX_FILTERS", 1)
    values = np.linspace(1, 2, 400)
    with pytest.raises(ArithmeticError):
        leading_pairs(lambda q: values[:, None] * q, 400, values.sum(), 16)
