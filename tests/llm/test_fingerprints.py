import hashlib
import random

import pytest

from korpusmill.llm.fingerprints import _common_length, fingerprint, fingerprint_edits, fingerprint_texts, likeness

rng = random.Random(2)


def prose(n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
    return row[-1]


def test_common_length_matches_the_plain_recurrence():
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in "ab")
        assert _common_length(a, b) == plain_common(a, b)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 4] + n[: len(t) // 4]
        a, b, c = fingerprint(t), fingerprint(edited), fingerprint(n)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


ROWS = [(i * 3, prose(rng.randint(0, 300))) for i in range(60)] + [(7, None), (8, ""), (9, "é😀" * 50), (10, "x" * 200_000), (11, "x"), (12, "abc")]


@pytest.mark.parametrize("buckets", [1, 2, 7, 100])
def test_neighbours_across_buckets(documents, buckets):
    got = sorted(map(tuple, fingerprint_edits(documents(ROWS), buckets).collect()), key=repr)
    assert got == expected(ROWS)


def test_ties_repeats_and_missing_ids(documents):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "z"), (None, "q" * 40), (None, None), (5, "w" * 9)]
    got = sorted(map(tuple, fingerprint_edits(documents(rows), 3).collect()), key=repr)
    assert got == expected(rows)


def test_small_tables(documents):
    assert fingerprint_edits(documents([])).collect() == []
    one = fingerprint_edits(documents([(4, "abcdefgh")])).first()
    assert (one["near_next"], one["edited_sha256"]) == (1.0, hashlib.sha256(b"abcdefab").hexdigest())


def test_edits_stay_alike_and_others_do_not():
    texts = [prose(rng.randint(30, 800)) for _ in range(60)]
    for a, b in zip(texts, texts[1:]):
        middle = a[: len(a) // 2] + " inserted words " + a[len(a) // 2 :]
        cut = a[: len(a) - len(a) // 4] + b[: len(a) // 4]
        assert likeness(fingerprint(a), fingerprint(a)) == 1
        assert likeness(fingerprint(a), fingerprint(middle)) > 0.6
        assert likeness(fingerprint(a), fingerprint(cut)) > 0.4
        assert likeness(fingerprint(a), fingerprint(b)) < 0.3


def test_whole_texts_count(documents):
    long = prose(40_000)
    assert fingerprint(long) != fingerprint(long[:-1] + "~") and likeness(fingerprint(long), fingerprint(long + " more")) > 0.8
    rows = fingerprint_texts(documents([(1, long), (None, None), (2, "")])).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {1: fingerprint(long), None: "3::", 2: "3::"}
