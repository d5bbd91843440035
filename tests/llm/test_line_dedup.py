import numpy as np
import pytest

from korpusmill.llm import line_dedup
from korpusmill.llm.line_dedup import Lookup, build_hash, dedup_lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(rows, min_docs=2):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    order = lambda d: 2**63 - 1 if d is None else d
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(order(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


ROWS = [
    (3, "shared line one\nown line of three\n\nshort\nSHARED LINE ONE \t"), (1, " Shared Line One\nshort\nÄÄÄÄÄÄÄÄÄÄ"), (2, "ää\x0bäÄÄÄÄÄÄÄÄÄ\nÄÄÄÄÄÄÄÄÄÄ\x0c"),
    (4, None), (5, ""), (6, "\n\n"), (None, "shared line one\nlone line of none"), (None, "lone line of none"), (7, "same doc same line\nsame doc same line"),
    (8, "shared line one"), (8, "shared line one"), (9, "x" * 9 + "\n" + "y" * 10), (10, "x" * 9 + "\n" + "y" * 10), (11, "\u00a0shared line one"),
    (12, "line " * 50_000 + "\n" + "shared line one\n" * 3000),
]


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("slice_probes", [1 << 20, 3])
def test_matches_brute_force_also_when_shards_are_sliced(documents, monkeypatch, slice_probes):
    monkeypatch.setattr(line_dedup, "SLICE_PROBES", slice_probes)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    out = dedup_lines(documents(ROWS))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "kept", "kept_text", "n_lines", "n_dropped"]
    assert got(out) == expected(ROWS)


@pytest.mark.parametrize("slice_probes", [1 << 20, 3])
@pytest.mark.parametrize("min_docs", [1, 3, 4, 6])
def test_counts_of_documents_decide(documents, monkeypatch, slice_probes, min_docs):
    monkeypatch.setattr(line_dedup, "SLICE_PROBES", slice_probes)
    want = expected(ROWS, min_docs)
    assert got(dedup_lines(documents(ROWS), min_docs=min_docs)) == want
    assert (want == expected(ROWS)) == (min_docs == 1)


def test_other_columns_may_have_any_name(documents):
    docs = documents(ROWS[:4]).withColumnsRenamed({"lang": "_doc", "source": "doc", "score": "drop", "kept": "_drop"})
    out = dedup_lines(docs)
    assert out.columns == [*docs.drop("kept_text").columns, "kept_text", "n_lines", "n_dropped"] and got(out) == expected(ROWS[:4])
    assert {(r["doc"], r["drop"]) for r in out.collect()} == {(r["doc"], r["drop"]) for r in docs.collect()}


def test_empty_table(documents):
    assert dedup_lines(documents([])).collect() == []


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 50_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    hi, lo = rng.integers(0, 1 << 40, (2, n)).astype(np.uint64)
    hi[: n // 3] = 7  # equal halves still make distinct keys
    keys = np.unique(np.stack([hi, lo]), axis=1)
    hi, lo = keys
    sizes, bits, slot = build_hash(hi, lo)
    assert sorted(slot) == list(range(len(hi)))
    assert (Lookup(sizes, bits).slots(hi, lo) == slot).all()
    assert sum(sizes) <= 4 * len(hi) + 64 * len(sizes)
    others = Lookup(sizes, bits).slots(hi + np.uint64(1 << 50), lo)
    assert ((others >= -1) & (others < max(1, len(hi)))).all()
