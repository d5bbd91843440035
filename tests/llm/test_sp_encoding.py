import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from korpusmill.llm.sp_encoding import MODEL, Encoder, decode_documents, encode_documents, load_pieces, round_trip

TEXTS = [
    "", " ", "   ", "a", "The quick brown fox.", "  two  spaces   ", "line\nbreaks\n\n and\ttabs\r\n", "日本語 😀 café Ünïcödé", "x\x00y\x7f",
    "word" * 400, "the " * 300, "\n", " \n ", "don't stop-me now, 3.14 and 1,000,000!", "▁ is a mark ▁▁", "ﬁ ½   nbsp",
]
PIECES = load_pieces()
PLAIN, DROPPING = Encoder(PIECES, 0), Encoder(PIECES, 0.2, seed=3)
PUBLIC = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ids(raw):
    return np.frombuffer(raw, np.int32).tolist()


def test_without_dropout_the_pieces_are_those_of_the_public_library():
    usual = [t for t in TEXTS if "▁" not in t]
    assert [ids(r) for r in PLAIN.encode(usual, [0] * len(usual))] == [PUBLIC.encode(t) for t in usual]


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_text_decodes_losslessly(text):
    for encoder in (PLAIN, DROPPING):
        assert encoder.decode(encoder.encode([text], [5])[0]) == text
    if "▁" not in text:
        assert ids(PLAIN.encode([text], [0])[0]) == PUBLIC.encode(text)


def test_dropout_varies_with_seed_document_and_place_and_repeats():
    text = "segmentation of international words " * 30
    one = DROPPING.encode([text], [1])[0]
    assert one == Encoder(PIECES, 0.2, seed=3).encode(["x y", text], [9, 1])[1]
    assert one != DROPPING.encode([text], [2])[0] != Encoder(PIECES, 0.2, seed=4).encode([text], [2])[0]
    assert len(one) > len(PLAIN.encode([text], [1])[0])
    spelt = Encoder(PIECES, 1.0).encode([text], [1])[0]
    assert len(ids(spelt)) == len(text) + 1  # every merge is skipped
    assert PUBLIC.decode(ids(one)) == text


def test_each_occurrence_of_a_word_has_skips_of_its_own():
    dropping = Encoder(PIECES, 0.5, seed=3)
    text = " internationally" * 2000
    seen = {tuple(ids(dropping.encode(["internationally"], [k])[0])) for k in range(200)}
    assert len(seen) > 30
    # Remembered pieces are those that merging each occurrence by itself gives; neighbouring documents are not shifted copies.
    long = text[1:] + " " + "x" + "internationally" * 5
    assert dropping.encode([long, "a b", long], [7, 1, 7])[::2] == [Encoder(PIECES, 0.5, seed=3).encode([long], [7])[0]] * 2
    assert dropping.encode([text[1:]], [7])[0][400:800] not in dropping.encode([text[1:]], [8])[0]


def test_remembered_pieces_are_those_of_merging_every_occurrence():
    words = ["internationally", "the", "segmentation", "a", "verylongwordwithoutanyspaceatall", "日本x"] * 50
    dropping, docs = Encoder(PIECES, 0.3, seed=3), [[" " + w for w in words]]
    dropping._learn(set(docs[0]))
    numbers = np.array([dropping.numbers[w] for w in docs[0]])
    salts = np.random.default_rng(1).integers(0, 2**64, len(words), np.uint64)
    got = [dropping.plain[i] for i in numbers]
    for place, raw in zip(*dropping._vary(docs, numbers, salts)):
        got[place] = raw
    assert got == [dropping._merge([w], salts[i : i + 1])[0][0] for i, w in enumerate(docs[0])]


def test_the_rate_of_skips_is_the_dropout():
    words = " ".join(f"{a}{b}" for a in "bcdfghjklm" for b in "aeiou")
    pair = lambda e, k: len(ids(e.encode([words], [k])[0]))
    plain = pair(PLAIN, 0)
    more = [pair(Encoder(PIECES, 0.5, seed=s), s) for s in range(10)]
    assert plain < np.mean(more) < 3 * 50


def test_tables(documents, spark):
    rows = list(enumerate(TEXTS)) + [(99, None), (None, "no id"), (3, TEXTS[3]), (100, "long text " * 30_000)]
    encoded = encode_documents(documents(rows).withColumnRenamed("score", "ids"))
    out = decode_documents(encoded).collect()
    assert len(out) == len(rows) and all(r["decoded"] == (r["text"] or "") and r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in out)
    short = {r["doc_id"]: r for r in round_trip(documents(rows)).collect()}
    assert all(r["lossless"] for r in short.values()) and {r["doc_id"]: r["n_pieces"] for r in out} == {d: r["n_pieces"] for d, r in short.items()}
    assert encode_documents(documents([])).collect() == [] and round_trip(documents([])).collect() == []


@pytest.mark.parametrize("dropout", [0, 0.1])
def test_batches_do_not_change_the_pieces(dropout):
    together = Encoder(PIECES, dropout).encode(TEXTS, list(range(len(TEXTS))))
    alone = [Encoder(PIECES, dropout).encode([t], [i])[0] for i, t in enumerate(TEXTS)]
    assert together == alone


def plain_agenda(word, key, place, dropout, seed):
    """Every turn looks at all pairs again: the best piece, the leftmost of equals, is merged or, by its hash, skipped."""
    full = 2**64 - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        return x ^ (x >> 31)

    salt = mix(mix(place + mix(key) & full) + seed * 0x9E3779B97F4A7C15 & full)
    known = {t: i for i, t in enumerate(PIECES.texts) if t is not None}
    symbols, skipped, turn = list(word.replace(" ", "▁")), set(), 0
    while True:
        at = [sum(map(len, symbols[:i])) for i in range(len(symbols))]
        pairs = [(-PIECES.scores[known[a + b]], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in known and (at[i], a, b) not in skipped]
        if not pairs:
            return [i for s in symbols for i in ([known[s]] if s in known else [PIECES.bytes[b] for b in s.encode()])]
        _, i = min(pairs)
        if mix(salt ^ turn) < int(dropout * 2.0**64):
            skipped.add((at[i], symbols[i], symbols[i + 1]))
        else:
            symbols[i : i + 2] = ["".join(symbols[i : i + 2])]
        turn += 1


@pytest.mark.parametrize("dropout", [0, 0.1, 0.6])
def test_pieces_are_those_of_a_plain_agenda(dropout):
    words = ["internationally", "the", "日本x", "aaaaaaaaaaaaaaaaaaa", "don't", "verylongwordwithoutanyspaceatall", "x", "abababababababab"]
    got = Encoder(PIECES, dropout, seed=3).encode([" ".join(words)], [11])[0]
    assert ids(got) == [i for place, w in enumerate(words) for i in plain_agenda(" " + w, 11, place, dropout, 3)]


LETTERS = "".join(chr(97 + n % 26) for n in np.random.default_rng(5).integers(0, 26 * 40, 40_000)) + "é日本" + "a" * 5000


def test_long_words_take_the_turns_of_short_ones(monkeypatch):
    from korpusmill.llm import sp_encoding

    assert ids(PLAIN.encode([LETTERS], [0])[0]) == PUBLIC.encode(LETTERS)
    text = LETTERS[:1500] + " internationally 日本x " + "ab" * 700 + " " + LETTERS[-1200:]
    heaps = [Encoder(PIECES, d, seed=3).encode([text], [4])[0] for d in (0, 0.3, 1)]
    monkeypatch.setattr(sp_encoding, "LONG", 10**9)
    assert heaps == [Encoder(PIECES, d, seed=3).encode([text], [4])[0] for d in (0, 0.3, 1)]
    monkeypatch.setattr(sp_encoding, "LONG", 1)
    assert heaps == [Encoder(PIECES, d, seed=3).encode([text], [4])[0] for d in (0, 0.3, 1)]
    assert PLAIN.encode(TEXTS, [0] * len(TEXTS)) == Encoder(PIECES, 0).encode(TEXTS, [0] * len(TEXTS))


def test_a_million_letters_without_a_blank():
    word = LETTERS[:40_000] * 25
    assert DROPPING.decode(DROPPING.encode([word], [1])[0]) == word


def test_ids_outside_the_vocabulary_have_no_text(spark):
    good = ids(PLAIN.encode(["good text"], [0])[0])
    rows = [(1, [*good[:2], None, -1, 10**9, *good[2:]]), (2, []), (3, None), (4, [None])]
    out = decode_documents(spark.createDataFrame(rows, "doc_id bigint, ids array<int>"))
    assert {r["doc_id"]: r["decoded"] for r in out.collect()} == {1: "good text", 2: "", 3: "", 4: ""}
