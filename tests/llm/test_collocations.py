import random
import re
from collections import Counter

import numpy as np
import pytest

from korpusmill.llm.collocations import collocations, phrase_counts, pieces, sort_suffixes

rng = random.Random(8)


def plain_pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def plain_counts(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for ws in plain_pieces(text):
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    return f, n


def expected(rows, least=10, top=2000):
    f, n = plain_counts(rows)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in candidates.items():
        over = any(l == lang and len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l, q), b in candidates.items())
        if not over:
            score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def table(spark, rows):
    wide = [(i, t, lang, -1, "x", 0.5) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id bigint, text string, lang string, n bigint, phrase string, score double")


def text(n, size):
    return "".join(rng.choice(["a", "b", "C", "the", "of", "é", "x" * rng.randint(1, 4)]) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\r", "\x0b", " ,"]) for _ in range(rng.randint(0, n)))[: size]


ROWS = [(rng.choice(["en", "de", None]), text(60, 400)) for _ in range(120)] + [("en", None), ("en", ""), (None, " . "), ("fr", "one two")] + [("en", "very common pair here")] * 200


def test_pieces():
    for t in ["A b\tC. d;E\x0bf\x0c g\r\nh\xa0i \x1cj", "", None, "..", "a..b "] + [t for _, t in ROWS]:
        assert [[w.decode() for w in p] for p in pieces(t) if p] == [p for p in plain_pieces(t) if p]


@pytest.mark.parametrize("size", [0, 1, 5, 300, 5000])
@pytest.mark.parametrize("words", [1, 3, 40, 4000])
def test_quicksort_counts_equal_prefixes(size, words):
    gen = np.random.default_rng(size + words)
    rows = gen.zipf(1.3, (3, size)).clip(1, words)
    rows[1][gen.random(size) < 0.2] = 0
    rows[2][(rows[1] == 0) | (gen.random(size) < 0.2)] = 0
    weights, spread = gen.integers(1, 4, size), (rows[0] % 3).astype(np.int64)
    sums = [Counter(), Counter(), Counter()]
    for i in range(size):
        for d in range(3):
            if rows[d][i]:
                sums[d][tuple(rows[: d + 1, i].tolist())] += int(weights[i])
    for d, (at, n) in enumerate(sort_suffixes(rows, weights, spread, 10)):
        got = [(tuple(rows[: d + 1, i].tolist()), int(c)) for i, c in zip(at, n)]
        assert len(dict(got)) == len(got)
        want = {p: c for p, c in sums[d].items() if c >= 10 or p[0] % 3 > d}
        assert dict(got) == {p: c for p, c in want.items()}


@pytest.mark.parametrize("options", [{}, {"shard_suffixes": 50, "hot_suffixes": 400}, {"shard_suffixes": 50, "hot_suffixes": 20}, {"shard_suffixes": 100, "hot_suffixes": 0}])
def test_matches_brute_force_on_any_routing(spark, options):
    got = sorted(map(tuple, collocations(table(spark, ROWS), **options).collect()))
    assert got == expected(ROWS)


def test_all_counts(spark):
    counts, langs = phrase_counts(table(spark, ROWS), least=3, shard_suffixes=40, hot_suffixes=30)
    f, n = plain_counts(ROWS)
    got = {(r["lang"], tuple(w for w in (r["w1"], r["w2"], r["w3"]) if w is not None)): r["f"] for r in counts.collect()}
    assert got == {k: c for k, c in f.items() if c >= 3}
    assert {r["lang"]: r["n"] for r in langs.collect()} == {k: c for k, c in n.items() if c or k in {"fr"}} | {k: 0 for k in n if not n[k]}


def test_ties_and_the_top(spark):
    rows = [("en", "b a. c a. é a. z a. b a c")] * 12
    assert sorted(map(tuple, collocations(table(spark, rows), top=3).collect())) == expected(rows, top=3)


def test_products_beyond_64_bits(spark):
    from korpusmill.llm.collocations import _score
    from pyspark.sql import functions as F

    a, l, r = 10**13 - 7, 3 * 10**13 + 1, 2 * 10**13 + 3
    assert spark.range(1).select(_score(F.lit(a), F.lit(l), F.lit(r))).first()[0] == 1_000_000 * a * a // (l * r)


def test_no_documents(spark):
    assert collocations(table(spark, [])).collect() == []
    assert collocations(table(spark, [("en", None)] * 20)).collect() == []
