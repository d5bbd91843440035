import itertools
import random

import numpy as np
import pytest

from korpusmill.llm import near_dedup
from korpusmill.llm.components import components
from korpusmill.llm.near_dedup import drop_near_duplicates, near_duplicates, odd_sketches

SPACE = " \t\n\x0b\x0c\r"


def shingles(text, n):
    words = [w for w in "".join(" " if c in SPACE else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def expected(rows, n, percent):
    docs = {}
    for i, (d, t) in enumerate(rows):
        docs.setdefault(d if d is not None else ("none", i), []).append(shingles(t, n))
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    named = [d for d in docs if not isinstance(d, tuple)]
    for a, b in itertools.combinations(named, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in docs[a] for y in docs[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    out = []
    for d, t in rows:
        part = None if d is None else min(e for e in named if find(e) == find(d))
        out.append((d, len(shingles(t, n)), part, d is None or part == d))
    return sorted(out, key=repr)


def made(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice("xyzuvw")
    rows, n = [], 0
    for _ in range(6):
        base = [word() for _ in range(rng.choice((12, 40, 120)))]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, len(base) // 8)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, (" " if rng.random() < 0.8 else "\n").join(copy)))
            n += 1
    rng.shuffle(rows)
    odd = [None, "", " \n", "one", "ONE", "one two", "One\x0btwo", "É a", "é a", "one", "w " * 20_000, "w " * 19_999 + "v"]
    return rows + [(1000 + i, t) for i, t in enumerate(odd)] + [(None, "one"), (None, None), (7, rows[0][1]), rows[0], (rows[1][0], rows[90][1])]


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize(("words", "block"), [(2, 1024), (2, 4), (5, 1024)])
def test_components_match_brute_force(documents, monkeypatch, words, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = made()
    assert got(near_duplicates(documents(rows), words, 80)) == expected(rows, words, 80)


def test_one_document_of_each_group_stays(documents):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "A b c d e  f g"), (4, "z"), (None, "a b c d e f g"), (5, None), (6, None)]
    out = drop_near_duplicates(documents(rows))
    assert out.columns == documents(rows).columns
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == [1, 4, 5, 6, None]


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []
    assert drop_near_duplicates(documents([])).collect() == []


def test_a_chain_is_one_component(spark):
    n = 60
    edges = [(i, i + 1) for i in range(n)] + [(5, 5), (100, 101), (101, 100), (100, 101)]
    roots = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert roots == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100}


def test_odd_sketch_is_the_parity_of_samples():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, (2, 240), dtype=np.uint32)
    x[1, :200] = x[0, :200]
    one, two = odd_sketches(x)
    alone = [odd_sketches(np.where(np.arange(240) >= 200, x[i], 0)[None])[0] for i in (0, 1)]
    assert ((one ^ two) == (alone[0] ^ alone[1])).all()  # equal samples cancel out
    assert 0 < np.bitwise_count(one ^ two).sum() <= near_dedup.most_differing_bits(0.8, 240)
