import random

import numpy as np
import pytest

from korpusmill.llm.decontaminate import align, drop_contaminated, leaks, word_hashes

rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(400)]
COMMON = ["the", "of", "a", "to"]


def prose(n):
    return [rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(WORDS) for _ in range(n)]


def edited(words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [w, rng.choice(WORDS)] if x < 2 * share / 3 else [rng.choice(WORDS)] if x < share else [w]
    return out


def slow_alignment(x, y):
    best, row = 0, [0] * (len(y) + 1)
    for a in x:
        above = row
        row = [0]
        for j, b in enumerate(y):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best = max(best, *row)
    return best


def test_alignment_matches_the_plain_recurrence():
    items, passages = [], []
    for _ in range(60):
        x = prose(rng.randint(1, 25))
        items.append(x)
        passages.append(prose(rng.randint(0, 9)) + edited(x, rng.random() * 0.6) + prose(rng.randint(0, 9)) or ["q"])
    scores, ends = align([word_hashes(" ".join(x)) for x in items], [word_hashes(" ".join(y)) for y in passages])
    assert scores.tolist() == [slow_alignment(x, y) for x, y in zip(items, passages)]
    assert all(slow_alignment(x, y[: e + 1]) == s and slow_alignment(x, y[:e]) < s for x, y, s, e in zip(items, passages, scores, ends) if s)


@pytest.fixture(scope="module")
def case():
    items = {i: prose(rng.randint(15, 60)) for i in range(20)}
    items[20], items[21] = prose(40), []
    rows, planted = [], set()
    for d in range(400):
        words = prose(rng.randint(5, 200))
        kind = d % 8
        if kind in (1, 2):
            i = rng.randrange(20)
            piece = items[i] if kind == 1 else edited(items[i], 0.2)
            at = rng.randint(0, len(words))
            words = words[:at] + piece + words[at:]
            planted.add((d, i))
        if kind == 3:  # an item that a large share of documents holds
            words += items[20]
            planted.add((d, 20))
        text = " ".join(words)
        rows.append((d, text.upper() if d % 5 == 0 else text.replace(" a ", ", a.\n")))
    return items, rows, planted


def test_finds_what_brute_force_finds(spark, documents, case):
    items, rows, planted = case
    rows = rows + [(400, None), (401, ""), (402, "x " * 50_000 + " ".join(items[3])), (0, rows[0][1]), (1, rows[1][1]), (None, " ".join(items[5]))]
    benchmark = [(i, " ".join(w), "q") for i, w in items.items()] + [(None, "none at all of it", "q"), (30, None, "q"), (31, "the", "q"), (3, " ".join(items[3]), "q")]
    found = leaks(documents(rows), spark.createDataFrame(benchmark, "item_id bigint, text string, doc string"))
    got = {(r["doc"], r["item_id"]): r["score"] for r in found.collect()}
    tokens = {d: " ".join((t or "").lower().replace(",", " ").replace(".", " ").split()).split() for d, t in rows if d is not None and d < 400}
    want = {(d, i): s for d, y in tokens.items() for i, x in items.items() if x and (s := slow_alignment(x, y) / (2 * len(x))) >= 0.4}
    assert planted <= want.keys()
    assert {k: v for k, v in got.items() if k[0] < 400} == pytest.approx(want)
    assert {k for k in got if k[0] >= 400} == {(402, 3), (2**63 - 1, 5)}


def test_drops_documents_with_items_and_no_others(spark, documents, case):
    items, rows, planted = case
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    docs = documents([*rows, (None, "clean"), (900, None)])
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in planted} | {None, 900}


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert leaks(documents([(1, "a b c")]), none).collect() == []
    assert leaks(documents([]), spark.createDataFrame([(1, "a b c d e f g h")], "item_id bigint, text string")).collect() == []
    assert np.array_equal(word_hashes("It's A-ÉB"), word_hashes("it s a Éb"))


def test_finds_edited_and_truncated_copies_that_are_common(spark, documents):
    fresh = [f"{a}{b}{c}" for a in "bcdfghkl" for b in "aeiou" for c in "mnprstvz"]
    items = {1: fresh[:40], 2: fresh[40:80]}
    copies = {1: [f"other{i // 5}" if i % 5 == 2 else w for i, w in enumerate(items[1])], 2: items[2][11:29]}
    rows = [(d, " ".join(prose(20) + copies[1 + d % 2] + prose(20)) if d % 4 < 2 else " ".join(prose(60))) for d in range(200)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    got = {(r["doc"], r["item_id"]): r["score"] for r in leaks(documents(rows), benchmark).collect()}
    assert got == pytest.approx({(d, 1 + d % 2): (0.7, 0.45)[d % 2] for d in range(200) if d % 4 < 2})
