import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from korpusmill.llm import maxent_lm as lm

rng = random.Random(4)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TONGUES = [["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(300)] for letters in ("abcdefg", "hijklmn", "opqrstu")]


def prose(n, tongue):
    return " ".join(TONGUES[tongue][int(rng.paretovariate(0.8)) % 300] if rng.random() < 0.97 else f"w{rng.randrange(10**6)}" for _ in range(n))


def tokens(text):
    return (text or "").translate(LOWER).encode().split() + [None]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


ROWS = [(i, prose(rng.randint(1, 120), i % 3)) for i in range(500)]
ROWS += [(900, None), (901, ""), (902, " \x0b\n"), (903, "É É é A a"), (None, "missing id"), (0, ROWS[0][1]), (904, "long " * 50_000)]


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.createDataFrame([(d, t, 1.0) for d, t in ROWS], "doc_id bigint, text string, score double")
    return lm.score_texts(docs, shard_chars=20_000).collect()


def test_counts_and_base_scores_match_brute_force(scored):
    counts = Counter(w for d, t in ROWS if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = [(d, held(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for d, t in ROWS]
    got = sorted((tuple(r)[:6] for r in scored), key=repr)
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def test_the_model_beats_the_base_on_held_out_texts(scored):
    out = [r for r in scored if r["held_out"]]
    assert len(out) > 40
    assert sum(r["score"] for r in out) > 0.9 * sum(r["base_score"] for r in out)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in scored)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(d, t) for d, t in ROWS[:120]], "doc_id bigint, text string")
    shards, counts, commonest = lm.to_shards(docs, 5_000, top_words=50)
    words = lm.find_words(shards, counts, commonest)
    weights = lm.train(shards, words)
    known = counts.where("c > 0").toPandas()
    hashes, c = np.append(known["hash"].to_numpy(), 12345), np.append(known["c"].to_numpy(), 0)  # and an unknown word
    number = {r["hash"]: i for i, r in enumerate(commonest)}
    _, cls, inside = words.describe(np.array([number.get(h, -1) for h in hashes]), c, hashes == lm.END)
    assert words.types == len(known) and words.tokens == known["c"].sum()
    one, two = np.array([0, 3, len(words.top), len(words.top) + 3]), np.array([1, 3, len(words.top), 0])
    logs = weights.log_classes(lm.feature_rows(one, two))
    assert (np.abs(weights.table).sum() > 0) and np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)
    total = np.exp(logs[:, cls] + inside).sum(axis=1)
    full = sorted(set(cls))
    assert np.allclose(total, np.exp(logs[:, full]).sum(axis=1), atol=1e-5)  # each class in use sums to one


def test_words_of_many_kinds_have_classes_of_their_own(spark):
    kinds = 24  # a word of one kind is always followed by one of the next
    texts = [(7 * d, " ".join(f"k{(d + i) % kinds}w{rng.randrange(5)}" for i in range(200))) for d in range(60)]
    shards, counts, commonest = lm.to_shards(spark.createDataFrame(texts, "doc_id bigint, text string"), 5_000)
    words = lm.find_words(shards, counts, commonest)
    names = {int(np.uint64(lm.xxhash.xxh3_64_intdigest(w.encode())).view(np.int64)): w.partition("w")[0] for _, t in texts for w in t.split()}
    kinds_of = [{names[r["hash"]] for r, c in zip(commonest, words.classes) if c == own} for own in range(lm.CLUSTERS)]
    assert len(commonest) == 5 * kinds and all(len(k) <= 1 for k in kinds_of)


def test_histories_do_not_cross_texts():
    one, two = lm._history(np.array([5, 6, 7, 8, 9]), np.array([1, 3, 1]), -1)
    assert one.tolist() == [-1, -1, 6, 7, -1] and two.tolist() == [-1, -1, -1, 6, -1]


def test_small_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.score_texts(none).collect() == []
    out = next(d for d in range(100) if held(d))
    r = lm.score_texts(spark.createDataFrame([(out, "a b")], "doc_id bigint, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and math.isfinite(r["score"])
